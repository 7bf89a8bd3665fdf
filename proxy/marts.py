"""Queries over the customer marts. The SQL side is written on its own terms:
begin and end values as separate scans, correlated lookups, plain windows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from proxy.core import query
from quotewell.functions import times
from quotewell.functions.times import asof_business_day
from quotewell.plans.marts import assets, flows, monthly, products as p, ranges
from quotewell.session import scratch_dir

DAY = "1998-06-30"
_D, _B, _M, _Y = "date '1998-06-30'", "date '1998-05-31'", "date '1998-06-01'", "date '1998-01-01'"
_OPEN, _CLOSED = "1998-06-29", "1998-06-28"


def _nz(expr: str) -> str:
    return f"coalesce({expr}, 0)"


# --- assets ----------------------------------------------------------------

_ACTIVE = f"""
select pty_id from {{mf_cust_attr_h}} where bgn_dt <= {_D} and end_dt > {_D}"""


def _at(table: str, column: str, day: str) -> str:
    return f"coalesce((select x.{column} from {{{table}}} x where x.data_dt = {day} and x.pty_id = c.pty_id), 0)"


_ASSETS = f"""
select {_D} as data_dt, c.pty_id, {_at('ms_cust_aset_d', 'tot_aset', _D)} as tot_aset_end,
  {_at('ms_cust_aset_d', 'tot_aset', _B)} as tot_aset_bgn, {_at('ms_cust_fc_aset_d', 'pur_aset', _D)} as pur_aset_end,
  {_at('ms_cust_fc_aset_d', 'pur_aset', _B)} as pur_aset_bgn
from {{active}} c"""


@query("assets_month", "data_dt:s pty_id:s tot_aset_end:d tot_aset_bgn:d pur_aset_end:d pur_aset_bgn:d", _ASSETS,
       {"active": _ACTIVE})
def assets_month(t):
    return assets.assets_month(t, DAY)


_SYSTEMS = ", ".join(
    f"sum(case when sys_source_cd = '{s}' then v else 0 end) as {c}" for s, c in assets.HOLDING_SYSTEMS.items())
_HELD = f"""
select h.pty_id, h.sys_source_cd, h.mkt_pft, h.mkt_val,
  case when q.prdt_type_id = 'PA040300' then '401156' else h.ccy end as ccy,
  case when q.prdt_type_id = 'PA040300' then coalesce((select r.exchange_rate from {{view_conv_rmb}} r
    where r.ccy = '401344' and r.data_dt = {_D}), 1) * h.mkt_val else h.mkt_val end as v,
  case when q.up_prdt_type_id = 'PA040000' then q.market_id end as share_market
from {{mf_cust_hold_d}} h join {{mf_prdt_attr_h}} q on q.prdt_id = h.prdt_id and q.bgn_dt <= {_D} and q.end_dt > {_D}
where h.data_dt = {_D} and (h.mkt_val <> 0 or h.mkt_pft <> 0)"""
_CASH = f"""
select pty_id, ccy, sum(bal) as bal, sum(avl_amt) as avl_amt, sum(frz_amt) as frz_amt, sum(draw_amt) as draw_amt
from {{mf_cust_cash_h}} where bgn_dt <= {_D} and end_dt > {_D}
  and (bal <> 0 or avl_amt <> 0 or frz_amt <> 0 or draw_amt <> 0) group by pty_id, ccy"""
_HELD_SUMS = f"""
select pty_id, ccy, sum(v) as val, sum(mkt_pft) as mkt_pft, {_SYSTEMS},
  sum(case when share_market in ('602010', '602040', '602050') then mkt_val else 0 end) as sh_mkt_val,
  sum(case when share_market in ('602020', '602030', '602060') then mkt_val else 0 end) as sz_mkt_val
from {{held_today}} group by pty_id, ccy"""


@query("assets_by_currency",
       "data_dt:s pty_id:s ccy:s tot_aset:d tot_mkt_val:d bal:d avl_amt:d frz_amt:d draw_amt:d mkt_pft:d "
       + " ".join(f"{c}:d" for c in assets.HOLDING_SYSTEMS.values())
       + " fund_in_transit:d sh_mkt_val:d sz_mkt_val:d", f"""
select {_D} as data_dt, pty_id, ccy, {_nz('bal')} + {_nz('val')} as tot_aset, {_nz('val')} as tot_mkt_val,
  {", ".join(f"{_nz(c)} as {c}" for c in ("bal", "avl_amt", "frz_amt", "draw_amt", "mkt_pft", *assets.HOLDING_SYSTEMS.values(), "sh_mkt_val", "sz_mkt_val"))},
  0 as fund_in_transit
from {{cash_sums}} full join {{held_sums}} using (pty_id, ccy)""",
       {"cash_sums": _CASH, "held_today": _HELD, "held_sums": _HELD_SUMS})
def assets_by_currency(t):
    return assets.assets_by_currency(t, DAY)


_OPEN_D = f"date '{_OPEN}'"
_RECALL = f"""
select c.data_dt, (select max(o.data_dt) from {{meta_sor_tran_dt_def}} o
    where o.data_dt <= c.data_dt and o.tran_dt_flag = 'Y') as recall_dt
from {{meta_sor_tran_dt_def}} c
where c.data_dt <= {_OPEN_D} and c.data_dt > (select max(o.data_dt) from {{meta_sor_tran_dt_def}} o
    where o.data_dt < {_OPEN_D} and coalesce(o.tran_dt_flag, 'Y') = 'Y')"""
_BALANCE_COLUMNS = [*assets.MARGIN_BALANCES, "aset_deb_amt", "tot_deb_amt", "pur_aset", "pur_aset_bef"]
_MARGIN_ALL = [*_BALANCE_COLUMNS, "finance_inte_bal", "shortsell_inte_bal", *assets.MARGIN_CASH]
_BALANCES = f"""
select d.data_dt, a.pty_id, a.ccy, {", ".join(f"sum(a.{c}) as {c}" for c in assets.MARGIN_BALANCES)},
  sum(a.deb_amt) as aset_deb_amt, sum(a.ass_bal - a.pur_aset) as tot_deb_amt, sum(a.pur_aset) as pur_aset,
  sum(a.pur_aset_bef) as pur_aset_bef,
  case when sum(a.ass_bal - a.pur_aset) = 0 then -1
       else round(cast(sum(a.ass_bal) as double) / cast(sum(a.ass_bal - a.pur_aset) as double), 4) end as close_rate
from {{his_fc_aset_deb}} a join {{recall_list}} d on a.data_dt = d.recall_dt
where a.ass_bal <> 0 or a.ass_bal <> a.pur_aset group by 1, 2, 3"""
_INTEREST = """
select a.data_dt, a.pty_id, a.ccy, sum(fina_deb_int_d) as finance_inte_bal, sum(stc_deb_int_d) as shortsell_inte_bal
from {mf_cust_fc_hold_d} a where sys_source_cd = '05' and a.data_dt in (select data_dt from {recall_list}) group by 1, 2, 3"""
_MARGIN_CASH = """
select d.data_dt, a.pty_id, a.ccy, sum(avl_amt) as avl_amt, sum(frz_amt) as frz_amt, sum(draw_amt) as draw_amt
from {his_aset_acct_fc} a join {recall_list} d on a.data_dt = d.recall_dt
where avl_amt <> 0 or frz_amt <> 0 or draw_amt <> 0 group by 1, 2, 3"""


@query("margin_assets_open", "data_dt:s pty_id:s ccy:s close_rate:d " + " ".join(f"{c}:d" for c in _MARGIN_ALL), f"""
select data_dt, pty_id, ccy, {_nz('close_rate')} as close_rate, {", ".join(f"{_nz(c)} as {c}" for c in _MARGIN_ALL)}
from {{margin_balances}} full join {{margin_interest}} using (data_dt, pty_id, ccy)
  full join {{margin_cash}} using (data_dt, pty_id, ccy)""",
       {"recall_list": _RECALL, "margin_balances": _BALANCES, "margin_interest": _INTEREST, "margin_cash": _MARGIN_CASH})
def margin_assets_open(t):
    return assets.margin_assets(t, _OPEN)


@query("margin_assets_closed", "data_dt:s pty_id:s ccy:s ass_bal:d", f"""
select date '{_CLOSED}' as data_dt, pty_id, ccy, ass_bal from {{prior_margin_assets}}
where data_dt = (select max(data_dt) from {{meta_sor_tran_dt_def}} where data_dt < date '{_CLOSED}' and tran_dt_flag = 'Y')""")
def margin_assets_closed(t):
    t["ms_cust_ccy_fc_aset_d"] = t["prior_margin_assets"]
    return assets.margin_assets(t, _CLOSED)


@query("asof_business_day", "data_dt:s tran_dt_flag:s recall_dt:s", """
select c.data_dt, c.tran_dt_flag, (select max(o.data_dt) from {meta_sor_tran_dt_def} o
  where o.data_dt <= c.data_dt and o.tran_dt_flag = 'Y') as recall_dt from {meta_sor_tran_dt_def} c""")
def asof_day(t):
    return asof_business_day(t["meta_sor_tran_dt_def"])


# --- flows -----------------------------------------------------------------

def _cost_sql(source: str, cost: str) -> str:
    """In, out and highest running net per customer, floored at 0."""
    return f"""
select pty_id, sum(i) as fin_in_amt, sum(o) as fin_out_amt, greatest(max(run), 0) as {cost} from (
  select pty_id, data_dt, i, o, sum(i - o) over (partition by pty_id order by data_dt) as run from (
    select pty_id, data_dt, sum(i) as i, sum(o) as o from ({source}) as f group by pty_id, data_dt) as g) as h
group by pty_id"""


def _margin_flow_sql(lo: str) -> str:
    period = f"data_dt between {lo} and {_D}"
    return f"""select pty_id, data_dt, assure_in_amt as i, assure_out_amt as o from {{vw_ms_cust_fc_tran_idx_d}} where {period}
union all select pty_id, data_dt, cash_in, cash_out from {{vw_ms_cust_fc_fin_idx_d}} where {period}"""


_IO_SPEC = "data_dt:s pty_id:s fin_in_amt:d fin_out_amt:d max_cost_fc:d"
_IO_MONTH = _cost_sql(_margin_flow_sql(_M), "max_cost_fc")


@query("io_max_cost_month", _IO_SPEC, f"select {_D} as data_dt, * from ({_IO_MONTH}) as x")
def io_max_cost_month(t):
    return flows.margin_io_month(t, DAY)


@query("io_max_cost_year", _IO_SPEC,
       f"select {_D} as data_dt, * from ({_cost_sql(_margin_flow_sql(_Y), 'max_cost_fc')}) as x")
def io_max_cost_year(t):
    return flows.margin_io_year(t, DAY)


@query("io_max_cost_year_incremental", _IO_SPEC,
       f"select {_D} as data_dt, * from ({_cost_sql(_margin_flow_sql(_Y), 'max_cost_fc')}) as x")
def io_max_cost_year_incremental(t):
    """The months before were stored in any order, one of them twice; the current month comes last."""
    path = scratch_dir(t.spark, "cost-states")
    past = flows.margin_flows(t, times.year_begin(DAY), times.previous_month_end(DAY))
    flows.store_cost_states(past.where("net_in > 0"), path, times.year_begin(DAY), times.previous_month_end(DAY))
    flows.store_cost_states(past, path, times.year_begin(DAY), times.previous_month_end(DAY))
    return flows.margin_io_year_incremental(t, DAY, path)


_MARGIN_BASE = f"""
select c.pty_id, {_at('ms_cust_fc_aset_d', 'pur_aset', _B)} as b, {_at('ms_cust_fc_aset_d', 'pur_aset', _D)} as e,
  {_nz('io.fin_in_amt')} as i, {_nz('io.fin_out_amt')} as o, {_nz('io.max_cost_fc')} as cost
from {{active}} c join {{ms_cust_info_ext_c}} k on k.pty_id = c.pty_id and k.fc_flag = 'Y'
left join {{io_month}} io on io.pty_id = c.pty_id"""
_RATE = """case when b + cost = 0 then 0
  else round(cast(e - b - i + o as double) / cast(b + cost as double), 4) end"""
_MARGIN_PROFIT = f"""
select * from (select pty_id, e - b - i + o as aset_pft, {_RATE} as max_cost_rate from {{margin_base}}) as r
where abs(max_cost_rate) <= 10"""
_MARGIN_CTES = {"active": _ACTIVE, "io_month": _IO_MONTH, "margin_base": _MARGIN_BASE, "margin_profit": _MARGIN_PROFIT}


@query("margin_profit_month", "data_dt:s pty_id:s aset_pft:d max_cost_rate:d",
       f"select {_D} as data_dt, * from {{margin_profit}}", _MARGIN_CTES)
def margin_profit_month(t):
    return flows.margin_profit_month(t, DAY)


@query("margin_report_month",
       "data_dt:s pty_id:s pur_aset_bgn:d pur_aset_end:d fin_in_amt:d fin_out_amt:d aset_pft:d max_cost_rate:d", f"""
select {_D} as data_dt, m.pty_id, b as pur_aset_bgn, e as pur_aset_end, i as fin_in_amt, o as fin_out_amt,
  {_nz('g.aset_pft')} as aset_pft, {_nz('g.max_cost_rate')} as max_cost_rate
from {{margin_base}} m left join {{margin_profit}} g on g.pty_id = m.pty_id""", _MARGIN_CTES)
def margin_report_month(t):
    return flows.margin_report_month(t, DAY)


_ALL_FLOWS = f"""
select pty_id, data_dt, cash_in + tran_in + assign_in + lmt_in_amt as i, cash_out + tran_out + assign_out as o
from {{ms_cust_fin_d}} where data_dt between {_M} and {_D}
union all select pty_id, data_dt, cash_in, cash_out from {{vw_ms_cust_fc_fin_idx_d}} where data_dt between {_M} and {_D}"""


@query("profit_to_date", "data_dt:s pty_id:s aset_pft:d max_cost_rate:d", f"""
select data_dt, pty_id, e - b - i + o as aset_pft,
  case when b + cost = 0 then 0 else cast(e - b - i + o as double) / cast(b + cost as double) end as max_cost_rate
from (select a.data_dt, a.pty_id, tot_aset_bgn + pur_aset_bgn as b, tot_aset_end + pur_aset_end as e,
        {_nz('f.fin_in_amt')} as i, {_nz('f.fin_out_amt')} as o, {_nz('f.cost')} as cost
      from {{month_assets}} a left join {{all_costs}} f on f.pty_id = a.pty_id) as x""",
       {"active": _ACTIVE, "month_assets": _ASSETS, "all_costs": _cost_sql(_ALL_FLOWS, "cost")})
def profit_to_date(t):
    return flows.profit_to_date(t, DAY)


# --- products --------------------------------------------------------------

def _in(codes) -> str:
    return "(" + ", ".join(f"'{c}'" for c in codes) + ")"


_VALID = f"select prdt_id, prdt_type_id, up_prdt_type_id from {{mf_prdt_attr_h}} where bgn_dt <= {_D} and end_dt > {_D}"
_SUMMED_CODES = [*p.TRADE_CODES.values(), *p.VALUED_CODES.values(), p.ALLOT, p.BONUS, p.NEW_STOCK]


def _margin_lines(lo: str) -> str:
    return f"""
select j.pty_id, j.stk_id as prdt_id, j.busi_cd, j.barg_cnt as q, j.ent_pri, j.barg_amt * r.exchange_rate as amt,
  j.rake * r.exchange_rate as rake, j.pur_rake * r.exchange_rate as pur_rake,
  j.barg_cnt * (case when coalesce(m.end_price, 0) = 0 then coalesce(m.nav, 0) else m.end_price end) * r.exchange_rate as worth
from {{sta_fc_jnls}} j join {{view_conv_rmb}} r on r.data_dt = j.data_dt and r.ccy = j.ccy
left join {{mf_prdt_mkt_d}} m on m.prdt_id = j.stk_id and m.data_dt = j.data_dt
where j.data_dt between {lo} and {_D} and j.busi_cd in {_in(_SUMMED_CODES)}"""


def _on(code: str, value: str, name: str) -> str:
    return f"sum(case when busi_cd = '{code}' then {value} else 0 end) as {name}"


_MARGIN_SUM_COLUMNS: dict[str, str] = {}
for _name, _code in p.TRADE_CODES.items():
    for _tail, _value in (("amt", "amt"), ("mnt", "q"), ("cnt", "1"), ("rake", "rake"), ("pur_rake", "pur_rake")):
        _MARGIN_SUM_COLUMNS[f"{_name}_{_tail}"] = _on(_code, _value, f"{_name}_{_tail}")
for _name, _code in p.VALUED_CODES.items():
    for _tail, _value in (("amt", "worth"), ("mnt", "q"), ("cnt", "1")):
        _MARGIN_SUM_COLUMNS[f"{_name}_{_tail}"] = _on(_code, _value, f"{_name}_{_tail}")
for _name, _code, _value in (("allot_stk", p.ALLOT, "q * ent_pri"), ("bonus_stk", p.BONUS, "worth"),
                             ("new_stk", p.NEW_STOCK, "q * ent_pri")):
    _MARGIN_SUM_COLUMNS[f"{_name}_mnt"] = _on(_code, "q", f"{_name}_mnt")
    _MARGIN_SUM_COLUMNS[f"{_name}_amt"] = _on(_code, _value, f"{_name}_amt")
_MARGIN_SUMS = f"select pty_id, prdt_id, {', '.join(_MARGIN_SUM_COLUMNS.values())} from {{margin_lines}} group by pty_id, prdt_id"


@query("margin_trade_summary", "pty_id:s prdt_id:s " + " ".join(
    f"{c}:{'i' if c.endswith('_cnt') else 'd'}" for c in _MARGIN_SUM_COLUMNS), _MARGIN_SUMS,
       {"margin_lines": _margin_lines(_M)})
def margin_trade_summary(t):
    return p.margin_trade_summary(t, p.month_begin(DAY), DAY)


def _entry_sql(codes) -> str:
    return f"""
select j.pty_id, j.stk_id as prdt_id, j.busi_cd, j.barg_amt * coalesce(r.exchange_rate, 1) as amt
from {{sta_stk_jnls}} j left join {{view_conv_rmb}} r on r.data_dt = j.data_dt and r.ccy = j.ccy
where j.data_dt between {_M} and {_D} and j.busi_cd in {_in(codes)}"""


# Profit as a ledger: every event of an account and product is one row with its
# signed money; a result is the sum of a key's rows.

def _values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return f"(values {body}) as {name}({columns})"


def _spent(bought: str, sold: str, *costs: str) -> str:
    return " - ".join([f"{_nz(sold)}", f"{_nz(bought)}", *map(_nz, costs)])


_REPO_NUMBERS = [pre + n for n in p.REPO_NUMBERS for pre in ("", "HG")]
_MONTH_DAYS = f"(select d_date from {{ana_dim_date}} where d_date between {_M} and {_D})"
_TWO_ENDS = f"(values ({_D}, 1), ({_B}, -1)) as ends(day, side)"
_SYS3 = "('01', '04', '07')"
_LISTED = """
select prdt_id, prdt_type_id, up_prdt_type_id from {valid_now}
where prdt_type_id <> 'PA040500' and up_prdt_type_id in ('PA030000', 'PA040000', 'PA080000')"""


def _positions(systems: str) -> str:
    """Both ends of the month: the end counts for, the beginning against."""
    return f"""
select side, pty_id, sys_source_cd as sys, prdt_id, data_dt, hold_dt, mkt_val * coalesce(exchange_rate, 1) as worth
from {{ms_cust_ccy_prdt_anahold_d}} as held join {_TWO_ENDS} on held.data_dt = day
left join {{view_conv_rmb}} as fx using (data_dt, ccy) where sys_source_cd in {systems}"""


_CORE_LEDGER = f"""
select pty_id, sys_source_cd as sys, prdt_id, buy_cnt as buys, sell_cnt as sells,
  {_spent("buy_amt", "sell_amt", "buy_rake + coalesce(buy_fare, 0)", "sell_rake + coalesce(sell_fare, 0)")} as money
from {{mf_cust_tran_core_m}} where data_dt = {_D}"""
_FUND_LEDGER = f"""
select pty_id, sys_source_cd as sys, prdt_id, exchange_rate * (tran_out - tran_in - allot_share_amt) as moved,
  exchange_rate * bonus_amt as bonus
from {{mf_cust_sys_fin_d}} join {{view_conv_rmb}} using (data_dt, ccy) where data_dt between {_M} and {_D}"""


def _entry_ledger(source: str, codes) -> str:
    """Sales bring money in and count as sales; all else takes it, and counts as a purchase unless it is the tax."""
    signs = [(c, 1 if c == p.SELL_ENTRY else -1, int(c not in (p.SELL_ENTRY, p.DIVIDEND_TAX)), int(c == p.SELL_ENTRY)) for c in codes]
    return f"""
select pty_id, '01' as sys, prdt_id, buys, sells, direction * amt as money
from {{{source}}} join {_values("signs", "busi_cd, direction, buys, sells", signs)} using (busi_cd)"""


_ORDINARY_LEDGER = f"""
select pty_id, sys, prdt_id, side > 0 as seen, case when side > 0 then 1 + date_diff('day', greatest({_M}, hold_dt), data_dt) else 0 end as days,
  0 as buys, 0 as sells, side * worth as money from {{ends_ordinary}}
union all
select pty_id, sys_source_cd, prdt_id, true, least(hold_days, 1 + date_diff('day', {_M}, data_dt)), 0, 0, 0
from {{ms_cust_ccy_prdt_anaunhold_d}} where sys_source_cd in {_SYS3} and data_dt between {_M} and {_D}
union all
select pty_id, '01', stk_id, true, 0, 0, 0, 0
from {{sta_stk_jnls}} where data_dt between {_M} and {_D}
union all
select pty_id, '01', if(contains(stk_id, '204'), '{p.REPO_PRODUCTS[0]}', '{p.REPO_PRODUCTS[1]}'), false, 0, 0, 0, clear_balance
from {{sta_stk_jnls}} where busi_cd in {_in(p.REPO_CODES)} and stk_id in {_in(_REPO_NUMBERS)} and data_dt between {_M} and {_D}
union all
select pty_id, sys, prdt_id, false, 0, buys, sells, money from {{core_ledger}} where sys in ('01', '04') and not starts_with(prdt_id, 'HG')
union all
select pty_id, sys, prdt_id, false, 0, buys, sells, money from {{entry_ledger}}
union all
select pty_id, sys, prdt_id, false, 0, 0, 0, {_nz("moved")} + {_nz("bonus")} from {{fund_ledger}}
union all
select pty_id, '01', prdt_id, false, 0, assure_out_cnt, assure_in_cnt, {_spent("assure_out_amt", "assure_in_amt")} from {{margin_sums}}"""
_ORDINARY_PROFIT = f"""
select pty_id, prdt_id, desk as flag, sum(days) as hold_days, {_nz("sum(buys)")} as buy_cnt, {_nz("sum(sells)")} as sell_cnt, sum(money) as tran_pft
from {{ordinary_ledger}} join {{listed}} using (prdt_id) join {_values("desks", "sys, desk", p.ACCOUNTS.items())} using (sys)
group by pty_id, prdt_id, desk having bool_or(seen)"""
_PLEDGED = f"""
select pty_id, prdt_id, '001' as flag, {p.PLEDGE_DAYS} as hold_days, sum(buy_cnt) as buy_cnt, sum(sell_cnt) as sell_cnt,
  sum(sell_amt) - sum(buy_amt) - sum(buy_rake) - sum(sell_rake) as tran_pft
from {{mf_cust_tran_core_m}} semi join (select prdt_id from {{valid_now}} where up_prdt_type_id = 'PA030000') as bonds using (prdt_id)
anti join {{ordinary_profit}} using (pty_id, prdt_id)
where sys_source_cd = '01' and data_dt = {_D} group by pty_id, prdt_id"""

# What a margin journal code is worth when bought and when sold, and whether it counts as a trade.
_LIMIT, _CLOSE, _TRADED = 1, 2, 3  # places in the list of amounts
_BOUGHT_AT = {p.ALLOT: _LIMIT, p.NEW_STOCK: _LIMIT, p.BONUS: _CLOSE, p.VALUED_CODES["assure_in"]: _CLOSE, p.VALUED_CODES["assure_out"]: _CLOSE}
_SOLD_AT = {p.VALUED_CODES["assure_in"]: _CLOSE, p.VALUED_CODES["assure_out"]: _CLOSE}
_PRICED = [
    (c, *row) for c in p.MONTH_TRADE_CODES for row in (
        (p.BUY, -1, _BOUGHT_AT.get(c, _TRADED), int(c not in (p.ALLOT, p.DIVIDEND_TAX)), 0),
        (p.SELL, 1, _SOLD_AT.get(c, _TRADED), 0, int(c not in (p.ALLOT, p.DIVIDEND_ENTRY))),
    )
]
_MARGIN_LEDGER = f"""
select pty_id, stk_id as prdt_id, false as seen, 0 as days, buys, sells,
  direction * {_nz("amounts[basis]")} - {_nz("exchange_rate * (rake + coalesce(fare1, 0) + coalesce(fare2, 0) + coalesce(fare3, 0) + coalesce(farex, 0))")} as money
from (
  select lines.*, exchange_rate, [ent_pri * barg_cnt, barg_cnt * end_price * exchange_rate, barg_amt * exchange_rate] as amounts
  from {{sta_fc_jnls}} as lines left join {{view_conv_rmb}} as fx using (data_dt, ccy)
  left join {{mf_prdt_mkt_d}} as market on market.prdt_id = lines.stk_id and market.data_dt = lines.data_dt
  where lines.data_dt in {_MONTH_DAYS}) as valued
join {_values("priced", "busi_cd, tran_dir_cd, direction, basis, buys, sells", _PRICED)} using (busi_cd, tran_dir_cd)
union all
select pty_id, prdt_id, true, 1 + date_diff('day', greatest({_M}, hold_dt), data_dt), 0, 0, 0
from {{margin_held}} where data_dt = {_D}
union all
select pty_id, prdt_id, true, least(hold_days, 1 + date_diff('day', {_M}, data_dt)), 0, 0, 0
from {{ms_cust_prdt_fc_unhold_d}} where data_dt in {_MONTH_DAYS}
union all
select pty_id, prdt_id, false, 0, 0, 0, - {_nz("deb_int_d")} from {{margin_held}} where data_dt in {_MONTH_DAYS}
union all
select pty_id, held.prdt_id, false, 0, 0, 0,
  side * {_nz("if(up_prdt_type_id = 'PA030000', mkt_val, (hold_cnt - stc_deb_mnt) * end_price)")}
from {{ms_cust_prdt_fc_hold_d}} as held join {_TWO_ENDS} on held.data_dt = day join {{listed}} using (prdt_id)
left join {{mf_prdt_mkt_d}} as market on market.data_dt = day and market.prdt_id = held.prdt_id"""
_MARGIN_HELD = "select * from {ms_cust_prdt_fc_hold_d} where not (hold_cnt = 0 and deb_mnt = 0)"
_MARGIN_PRODUCT = f"""
select pty_id, prdt_id, '{p.MARGIN_ACCOUNT}' as flag, sum(days) as hold_days, sum(buys) as buy_cnt, sum(sells) as sell_cnt, sum(money) as tran_pft
from {{margin_ledger}} semi join {{listed}} using (prdt_id) group by pty_id, prdt_id having bool_or(seen)"""
_PRODUCT_PROFIT = " union all ".join(
    f"select pty_id, prdt_id, flag, hold_days, buy_cnt, sell_cnt, cast(tran_pft as decimal(30,8)) as tran_pft from {{{x}}}"
    for x in ("ordinary_profit", "pledged_profit", "margin_product"))
_PRODUCT_CTES = {
    "valid_now": _VALID, "listed": _LISTED, "margin_lines": _margin_lines(_M), "margin_sums": _MARGIN_SUMS,
    "entry_lines": _entry_sql(p.ENTRY_CODES_MONTH), "entry_ledger": _entry_ledger("entry_lines", p.ENTRY_CODES_MONTH),
    "core_ledger": _CORE_LEDGER, "fund_ledger": _FUND_LEDGER, "ends_ordinary": _positions(_SYS3), "ordinary_ledger": _ORDINARY_LEDGER,
    "ordinary_profit": _ORDINARY_PROFIT, "pledged_profit": _PLEDGED, "margin_held": _MARGIN_HELD, "margin_ledger": _MARGIN_LEDGER,
    "margin_product": _MARGIN_PRODUCT, "product_profit": _PRODUCT_PROFIT,
}


@query("product_profit_month", "data_dt:s pty_id:s prdt_id:s flag:s hold_days:i buy_cnt:i sell_cnt:i tran_pft:d",
       f"select {_D} as data_dt, * from {{product_profit}}", _PRODUCT_CTES)
def product_profit_month(t):
    return p.product_profit_month(t, DAY)


# The same SQL once for each of twelve months, its dates and names changed.
_YEAR = [(1997, m) for m in range(7, 13)] + [(1998, m) for m in range(1, 7)]
_RANGE_CTES: dict[str, str] = {}
for _year, _month in _YEAR:
    _first = date(_year, _month, 1)
    _days = {_D: (_first + timedelta(31)).replace(day=1) - timedelta(1), _B: _first - timedelta(1), _M: _first}
    for _name, _text in _PRODUCT_CTES.items():
        for _old in _PRODUCT_CTES:
            _text = _text.replace("{" + _old + "}", "{" + f"{_old}_{_month}" + "}")
        # first all at once to marks, since one month's begin may be another's end
        for _i, _was in enumerate(_days):
            _text = _text.replace(_was, f"<{_i}>")
        for _i, _is in enumerate(_days.values()):
            _text = _text.replace(f"<{_i}>", f"date '{_is}'")
        _RANGE_CTES[f"{_name}_{_month}"] = _text
    _RANGE_CTES[f"run_{_month}"] = f"select date '{_days[_D]}' as data_dt, * from {{product_profit_{_month}}}"


@query("product_profit_range", "data_dt:s pty_id:s prdt_id:s flag:s hold_days:i buy_cnt:i sell_cnt:i tran_pft:d",
       " union all ".join(f"select * from {{run_{m}}}" for _, m in _YEAR), _RANGE_CTES)
def product_profit_range(t):
    return ranges.product_profit_range(t, "1997-07-31", "1998-06-30")


_WEALTH = f"""
select prdt_id from {{valid_now}} where prdt_type_id = 'PA070100' and prdt_id <> 'TA940018'"""


@query("wealth_products_month", "data_dt:s pty_id:s prdt_cnt:d buy_cnt:d sell_cnt:d", f"""
select {_D} as data_dt, pty_id, sum(n) as prdt_cnt, sum(b) as buy_cnt, sum(s) as sell_cnt from (
  select pty_id, count(distinct prdt_id) as n, null as b, null as s from (
    select pty_id, prdt_id from {{ms_cust_prdt_hold_d}} where data_dt = {_D}
    union all select pty_id, prdt_id from {{ms_cust_prdt_unhold_d}} where data_dt in {_MONTH_DAYS}
    union all select pty_id, prdt_id from {{ms_cust_prdt_fc_hold_d}} where data_dt = {_D} and (hold_cnt <> 0 or deb_mnt <> 0)
    union all select pty_id, prdt_id from {{ms_cust_prdt_fc_unhold_d}} where data_dt in {_MONTH_DAYS}) as h
  where prdt_id in (select prdt_id from {{wealth}}) group by pty_id
  union all
  select pty_id, null, sum(buy_cnt), sum(sell_cnt) from {{mf_cust_tran_core_m}}
  where data_dt = {_D} and sys_source_cd in ('02', '03') and prdt_id in (select prdt_id from {{wealth}}) group by pty_id) as u
group by pty_id""", {"valid_now": _VALID, "wealth": _WEALTH})
def wealth_products_month(t):
    return p.wealth_products_month(t, DAY)


@query("share_trades_day", "data_dt:s pty_id:s buy_cnt:i sell_cnt:i", f"""
select {_D} as data_dt, pty_id, sum(b) as buy_cnt, sum(s) as sell_cnt from (
  select pty_id, prdt_id, buy_cnt as b, sell_cnt as s from {{mf_cust_tran_core_d}} where data_dt = {_D} and sys_source_cd <> '05'
  union all select pty_id, stk_id, case when busi_cd = '406004021' then 0 else 1 end, case when busi_cd = '406004021' then 1 else 0 end
    from {{sta_stk_jnls}} where data_dt = {_D} and busi_cd in {_in(p.ENTRY_CODES_DAY)}
  union all select pty_id, prdt_id, assure_out_cnt, assure_in_cnt from {{margin_sums}}
  union all select pty_id, stk_id, case when tran_dir_cd = '603010' and busi_cd <> '406004014' then 1 else 0 end,
      case when tran_dir_cd = '603020' and busi_cd <> '406004014' then 1 else 0 end
    from {{sta_fc_jnls}} where data_dt = {_D} and busi_cd in {_in(p.DAY_TRADE_CODES)}) as u
where prdt_id in (select prdt_id from {{valid_now}} where up_prdt_type_id = 'PA040000') group by pty_id""",
       {"valid_now": _VALID, "margin_lines": _margin_lines(_D), "margin_sums": _MARGIN_SUMS})
def share_trades_day(t):
    return p.share_trades_day(t, DAY)


# --- the monthly report ----------------------------------------------------

_LEVEL = """coalesce((select x.end_price from {{sta_gti_mkt_pnt}} x where x.mkt_type_cd = '000001' and x.end_price is not null
  and x.data_dt <= {day} and x.data_dt >= date '1998-05-22'
  and x.data_dt in (select data_dt from {{meta_sor_tran_dt_def}}) order by x.data_dt desc limit 1), 0)"""
_INDEX = f"""
select case when b = 0 then 0 else round(cast(e - b as double) / cast(b as double), 4) end as hs_300_rate
from (select {_LEVEL.format(day=_B)} as b, {_LEVEL.format(day=_D)} as e) as x"""


def _size(column: str, condition: str) -> str:
    return (f"(select {column} from {{sta_port_simulationinfo}} where portid = 1 and {condition} "
            "order by pubdate desc limit 1)")


_NEXT = "date '1998-07-01'"
_YIELD = f"""
select (cast(c as double) - cast(coalesce(b, f) as double)) / nullif(cast(coalesce(b, f) as double), 0) as jn_yield
from (select {_size('capitaltotal', f'pubdate >= {_M} and pubdate < {_NEXT}')} as c,
  {_size('fundsizefirst', f'pubdate >= {_M} and pubdate < {_NEXT}')} as f, {_size('capitaltotal', f'pubdate < {_M}')} as b) as x"""


@query("index_return", "hs_300_rate:d", _INDEX)
def index_return(t):
    return monthly.index_return(t, DAY)


@query("portfolio_yield", "jn_yield:d", _YIELD)
def portfolio_yield(t):
    return monthly.portfolio_yield(t, DAY)


_SYS5 = "('01', '02', '03', '04', '08')"
_CLASSES = f"""
select distinct on (prdt_id) prdt_id, prdt_type_id, up_prdt_type_id from {{mf_prdt_attr_h}}
where end_dt > {_B} and bgn_dt <= {_D} and (up_prdt_type_id in ('PA050000', 'PA090000', 'PA100000') or prdt_type_id in ('PA040500', 'PA070100'))
order by prdt_id, end_dt desc"""
_BOOK_GAIN = f"""
select pty_id, sys, prdt_id, sum(money) as gain from (
  select pty_id, sys, prdt_id, side > 0 as seen, side * worth as money from {{ends_all}}
  union all
  select pty_id, '05', prdt_id, side > 0, side * mkt_val from {{ms_cust_prdt_fc_hold_d}} join {_TWO_ENDS} on data_dt = day
  where side < 0 or not (hold_cnt = 0 and deb_mnt = 0)
  union all
  select pty_id, coalesce(sys_source_cd, '05'), prdt_id, true, 0 from (
    select data_dt, pty_id, sys_source_cd, prdt_id from {{ms_cust_ccy_prdt_anaunhold_d}} where sys_source_cd in {_SYS5}
    union all select data_dt, pty_id, null, prdt_id from {{ms_cust_prdt_fc_unhold_d}}) as left_over where data_dt in {_MONTH_DAYS}) as ledger
group by pty_id, sys, prdt_id having bool_or(seen)"""
_TRADE_GAIN = f"""
select pty_id, sys, prdt_id, money as gain from {{core_ledger}}
union all select pty_id, sys, prdt_id, money from {{report_ledger}}
union all select pty_id, sys, prdt_id, moved + bonus from {{fund_ledger}}"""


def _classed(source: str) -> str:
    fund = "(up_prdt_type_id = 'PA050000' or prdt_type_id = 'PA040500')"
    wealth = "(prdt_type_id = 'PA070100' or up_prdt_type_id in ('PA090000', 'PA100000'))"
    return f"""
select pty_id, cast(sum(case when {wealth} then gain else 0 end) as decimal(20,4)) as fina,
  cast(sum(case when {fund} and sys = '02' then gain else 0 end) as decimal(20,4)) as fund,
  cast(sum(case when {fund} and sys <> '02' then gain else 0 end) as decimal(20,4)) as inn
from {source} g join {{classes}} c on c.prdt_id = g.prdt_id where g.prdt_id <> 'TA940018' group by pty_id"""


_CLASS_PROFIT = (f"select pty_id, sum(fina) as fina, sum(fund) as fund, sum(inn) as inn from ("
                 f"{_classed('{book_gain}')} union all {_classed('{trade_gain}')}) as u group by pty_id")
_BUCKETS = [(desk, kind, bucket) for desk in ("001", "004", "105") for kind, bucket in (("PA040000", "shares"), ("PA030000", "bonds"), ("PA080000", "bonds"))]
_SHARE_PROFIT = f"""
select pty_id, {", ".join(f"coalesce(sum(tran_pft) filter (where bucket = '{b}'), 0) as {c}" for b, c in (("shares", "gp"), ("limited", "lmt"), ("bonds", "zq")))}
from {{product_profit}} join {{valid_now}} using (prdt_id)
left join {_values("buckets", "flag, up_prdt_type_id, bucket", [*_BUCKETS, ("007", "PA040000", "limited")])} using (flag, up_prdt_type_id)
group by pty_id"""
_CASH_FUND = f"""
select j.pty_id, sum((case when j.busi_cd = '406000142' then -j.barg_cnt else j.barg_cnt end) * coalesce(r.exchange_rate, 1)) as shares
from {{sta_fund_jnls}} j left join {{view_conv_rmb}} r on r.data_dt = j.data_dt and r.ccy = j.ccy
where j.data_dt between {_M} and {_D} and j.fund_id = 'TA940018' and j.busi_cd in ('406000142', '406000143') group by j.pty_id"""
_CLASS_CTES = {
    "classes": _CLASSES, "ends_all": _positions(_SYS5), "book_gain": _BOOK_GAIN, "report_entries": _entry_sql(monthly.ENTRY_CODES),
    "core_ledger": _CORE_LEDGER, "fund_ledger": _FUND_LEDGER, "report_ledger": _entry_ledger("report_entries", monthly.ENTRY_CODES),
    "trade_gain": _TRADE_GAIN,
    "class_profit": _CLASS_PROFIT,
}


@query("class_profit", "pty_id:s fina_tran_pft:d fund_tran_pft:d in_tran_pft:d",
       "select pty_id, fina as fina_tran_pft, fund as fund_tran_pft, inn as in_tran_pft from {class_profit}", _CLASS_CTES)
def class_profit(t):
    return monthly.class_profit(t, DAY)


@query("share_profit", "pty_id:s gp_tran_pft:d lmt_tran_pft:d zq_tran_pft:d",
       "select pty_id, gp as gp_tran_pft, lmt as lmt_tran_pft, zq as zq_tran_pft from {share_profit}",
       {**_PRODUCT_CTES, "share_profit": _SHARE_PROFIT})
def share_profit(t):
    return monthly.share_profit(t, DAY)


@query("cash_fund_yield", "pty_id:s pur_ttf_profit:d", "select pty_id, shares as pur_ttf_profit from {cash_fund}",
       {"cash_fund": _CASH_FUND})
def cash_fund_yield(t):
    return monthly.cash_fund_yield(t, DAY)


@query("profit_rank_share", "o_orderkey:i share:d", """
select o_orderkey, 1.0 - cast(rank() over (order by v desc) as double) / count(*) over () as share
from (select o_orderkey, floor(o_totalprice / 100) as v from {orders}) as x""")
def profit_rank_share(t):
    rows = t["orders"].select("o_orderkey", F.floor(F.col("o_totalprice") / 100).alias("v"))
    return monthly.rank_share(rows, "v", "share")


_REPORT_BASE = f"""
select a.pty_id, tot_aset_bgn + pur_aset_bgn as b, tot_aset_end + pur_aset_end as e, {_nz('h.in_aset_m')} as i,
  {_nz('h.out_aset_m')} as o, {_nz('h.max_cost_aset_m')} as cost
from {{month_assets}} a left join {{ms_cust_char_io_aset_m}} h on h.pty_id = a.pty_id and h.data_dt = {_D}"""
_REPORT_RATED = """
select *, e - b - i + o as gain, case when b + cost = 0 then 0
  else cast(e - b - i + o as double) / cast(b + cost as double) end as rate from {report_base}"""


def _one(table: str, column: str, day: str) -> str:
    return f"coalesce((select x.{column} from {{{table}}} x where x.data_dt = {day} and x.pty_id = r.pty_id), 0)"


_PRIOR = _one("ms_cust_zl_cost_m", "aset_pft", _B)


@query("report_month",
       "data_dt:s pty_id:s pur_aset_bgn:d pur_aset_end:d fin_in_amt:d fin_out_amt:d aset_pft:d max_cost_rate:d "
       "max_cost_rate_num:d stk_tran_cnt_m:i avg_aset_scale_m:d risk_habit_char:s hold_idst_char:s aset_pft_rate:d "
       "hs_300_rate:d jn_yield:d pur_ttf_profit:d pur_fina_profit:d gp_tran_pft:d fund_tran_pft:d lmt_tran_pft:i zq_tran_pft:i", f"""
select {_D} as data_dt, r.pty_id, r.b as pur_aset_bgn, r.e as pur_aset_end, r.i as fin_in_amt, r.o as fin_out_amt,
  r.gain as aset_pft, r.rate as max_cost_rate,
  1.0 - cast(rank() over (order by r.rate desc) as double) / (select count(*) from {{report_rated}}) as max_cost_rate_num,
  {_one('ms_cust_char_tran_m', 'stk_tran_cnt_m', _D)} as stk_tran_cnt_m,
  {_one('ms_cust_char_aset_m', 'avg_aset_scale_m', _D)} as avg_aset_scale_m, risk.describe as risk_habit_char,
  ind.describe as hold_idst_char,
  case when {_PRIOR} = 0 then 0 else round(cast(r.gain - {_PRIOR} as double) / cast({_PRIOR} as double), 4) end as aset_pft_rate,
  (select hs_300_rate from {{index_rate}}) as hs_300_rate, coalesce((select jn_yield from {{port_yield}}), 0) as jn_yield,
  {_nz('cf.shares')} as pur_ttf_profit, {_nz('cp.fina')} as pur_fina_profit, {_nz('sp.gp')} + {_nz('cp.inn')} as gp_tran_pft,
  {_nz('cp.fund')} as fund_tran_pft, 0 as lmt_tran_pft, 0 as zq_tran_pft
from {{report_rated}} r
left join {{ms_cust_char_obj_h}} obj on obj.pty_id = r.pty_id left join {{sta_code}} risk on risk.code = obj.risk_habit_cd2
left join {{ms_cust_char_rank_m}} tst on tst.pty_id = r.pty_id and tst.char_id = '809050' and tst.rank = 1 and tst.data_dt = {_D}
left join {{sta_code}} ind on ind.code = tst.char_value
left join {{cash_fund}} cf on cf.pty_id = r.pty_id left join {{class_profit}} cp on cp.pty_id = r.pty_id
left join {{share_profit}} sp on sp.pty_id = r.pty_id""",
       {**_PRODUCT_CTES, **_CLASS_CTES, "active": _ACTIVE, "month_assets": _ASSETS, "share_profit": _SHARE_PROFIT,
        "cash_fund": _CASH_FUND, "index_rate": _INDEX, "port_yield": _YIELD, "report_base": _REPORT_BASE,
        "report_rated": _REPORT_RATED})
def report_month(t):
    t["ms_cust_aset_m"] = assets.assets_month(t, DAY)
    return monthly.report_month(t, DAY)
