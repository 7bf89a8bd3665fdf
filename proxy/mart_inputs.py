"""Customer-mart inputs derived from the driver tables: suppliers stand for
customers, groups of parts for products, lines for journals and positions."""

from proxy.core import INPUTS

# Codes the marts look at, spread over the lines in turn.
_JOURNAL_CODES = (
    "406004001", "406004002", "406004014", "406004015", "406004016", "406004018", "406004021", "406004022",
    "406004034", "406004121", "406004201", "406004202", "406004206", "406004211", "406004212", "406004213",
    "406004214", "406004215", "406004216", "406002434", "406009999",
)
_CODE = " ".join(f"when {i} then '{c}'" for i, c in enumerate(_JOURNAL_CODES))

INPUTS["line_base"] = """
select concat('C', cast(l_suppkey as string)) as pty_id,
       concat('P', cast(cast(floor(l_partkey / 200) as bigint) as string)) as prdt_id,
       cast(l_shipdate as date) as dt, last_day(cast(l_shipdate as date)) as mdt, l_orderkey as ok, l_linenumber as ln,
       l_returnflag as rf, l_linestatus as ls, concat('0', cast(l_linenumber as string)) as sys,
       case l_returnflag when 'A' then '401156' when 'R' then '401344' else '401840' end as ccy,
       cast(l_extendedprice as decimal(12,2)) as amt, cast(l_quantity as decimal(8,0)) as qty,
       cast(l_discount as decimal(4,2)) as disc, cast(l_tax as decimal(4,2)) as tax
from {lineitem}"""

# --- dimensions ------------------------------------------------------------

INPUTS["mf_cust_attr_h"] = """
select concat('C', cast(s_suppkey as string)) as pty_id, date '1995-01-01' as bgn_dt,
       case when s_acctbal < 500 then date '1998-06-30' else date '2999-12-31' end as end_dt
from {supplier}"""

INPUTS["ms_cust_info_ext_c"] = """
select concat('C', cast(s_suppkey as string)) as pty_id, case when s_nationkey < 18 then 'Y' else 'N' end as fc_flag
from {supplier}"""

INPUTS["part_groups"] = """
select cast(floor(p_partkey / 200) as bigint) as k, min(p_size) as smallest from {part}
group by cast(floor(p_partkey / 200) as bigint)"""

INPUTS["mf_prdt_attr_h"] = """
select concat('P', cast(k as string)) as prdt_id,
       case mod(k, 6) when 0 then 'PA040300' when 1 then 'PA070100' when 2 then 'PA040500' when 3 then 'PA040100'
                      when 4 then 'PA050100' else 'PA030100' end as prdt_type_id,
       case when k = 9 then 'PA080000' else case mod(k, 6) when 0 then 'PA040000' when 1 then 'PA090000'
                      when 2 then 'PA050000' when 3 then 'PA040000' when 4 then 'PA050000' else 'PA030000' end
       end as up_prdt_type_id,
       case mod(k, 3) when 0 then '602010' when 1 then '602020' else '609999' end as market_id,
       case when mod(k, 4) = 1 then date '1998-06-10' else date '1995-01-01' end as bgn_dt, date '2999-12-31' as end_dt
from {part_groups}
union all
select concat('P', cast(k as string)), 'PA040500', 'PA050000', '602010', date '1990-01-01', date '1998-06-10'
from {part_groups} where mod(k, 4) = 1
union all
select 'ZQ888880', 'PA030100', 'PA030000', '602010', date '1990-01-01', date '2999-12-31' from {part_groups} where k = 0
union all
select 'HG204001', 'PA080100', 'PA080000', '602010', date '1990-01-01', date '2999-12-31' from {part_groups} where k = 0"""

INPUTS["calendar_days"] = """
select distinct cast(l_shipdate as date) as d from {lineitem}
union select distinct cast(o_orderdate as date) from {orders}"""

INPUTS["meta_sor_tran_dt_def"] = """
select d as data_dt, case when <<ISODOW d>> > 5 then 'N' when extract(day from d) = 15 then null else 'Y' end as tran_dt_flag
from {calendar_days}"""

INPUTS["ana_dim_date"] = "select d as d_date from {calendar_days} where extract(day from d) <> 13"

INPUTS["view_conv_rmb"] = """
select dt as data_dt, ccy, cast(1 + min(disc) as decimal(8,4)) as exchange_rate from {line_base}
where disc < 0.06 group by dt, ccy"""

INPUTS["mf_prdt_mkt_d"] = """
select data_dt, prdt_id, case when min(ln) = 1 then cast(0 as decimal(12,4)) else cast(max(qty) as decimal(12,4)) end as end_price,
       cast(min(qty) as decimal(12,4)) as nav
from (select dt as data_dt, prdt_id, ln, qty from {line_base} where ln < 7
      union all select mdt, prdt_id, ln + 1, qty from {line_base} where dt < mdt) as both_days
group by data_dt, prdt_id"""

INPUTS["sta_code"] = "select cast(n_nationkey as string) as code, n_name as describe from {nation} where n_nationkey < 22"

# --- assets, cash, flows ---------------------------------------------------

INPUTS["ms_cust_aset_d"] = """
select mdt as data_dt, pty_id, cast(sum(amt) as decimal(18,2)) as tot_aset from {line_base} where ls = 'O' group by mdt, pty_id"""

INPUTS["ms_cust_fc_aset_d"] = """
select mdt as data_dt, pty_id, cast(sum(amt) as decimal(18,2)) as pur_aset from {line_base}
where ls = 'F' and rf <> 'N' group by mdt, pty_id"""

INPUTS["mf_cust_cash_h"] = """
select concat('C', cast(s_suppkey as string)) as pty_id, case when s_nationkey < 12 then '401156' else '401840' end as ccy,
       case when s_nationkey = 3 then cast(0 as decimal(12,2)) else cast(s_acctbal as decimal(12,2)) end as bal,
       case when s_nationkey = 3 then cast(0 as decimal(12,2)) else cast(s_acctbal as decimal(12,2)) - 1 end as avl_amt,
       cast(0 as decimal(12,2)) as frz_amt,
       case when s_nationkey = 3 then cast(0 as decimal(12,2)) else cast(s_acctbal as decimal(12,2)) - 2 end as draw_amt,
       date '1996-01-01' as bgn_dt,
       case when s_nationkey = 5 then date '1998-06-30' else date '2999-12-31' end as end_dt
from {supplier}"""

INPUTS["mf_cust_hold_d"] = """
select mdt as data_dt, pty_id, ccy, prdt_id, sys as sys_source_cd, amt as mkt_val, cast(amt * disc as decimal(16,4)) as mkt_pft
from {line_base}"""

INPUTS["his_fc_aset_deb"] = """
select dt as data_dt, pty_id, ccy, amt as ass_bal, qty as bal, amt as cls_mkt_val, amt * tax as cls_mkt_val_asur,
       qty * 2 as fina_deb, qty * 3 as stc_deb, qty * 4 as cls_fare_deb, qty * 5 as cls_oth_deb, disc as cls_fina_int,
       tax as cls_shtcel_int, disc * 2 as cls_fare_int, tax * 2 as cls_oth_int, amt * disc as deb_amt,
       case when ln = 7 then cast(amt as decimal(16,4)) else cast(amt * disc as decimal(16,4)) end as pur_aset,
       cast(amt * tax as decimal(16,4)) as pur_aset_bef
from {line_base}"""

INPUTS["mf_cust_fc_hold_d"] = """
select dt as data_dt, pty_id, ccy, sys as sys_source_cd, cast(amt * disc as decimal(16,4)) as fina_deb_int_d,
       cast(amt * tax as decimal(16,4)) as stc_deb_int_d from {line_base}"""

INPUTS["his_aset_acct_fc"] = """
select dt as data_dt, pty_id, ccy, case when ln = 3 then 0 * amt else amt end as avl_amt, 0 * amt as frz_amt,
       case when ln < 4 then 0 * qty else qty end as draw_amt from {line_base}"""

INPUTS["prior_margin_assets"] = """
select dt as data_dt, pty_id, ccy, cast(sum(amt) as decimal(18,2)) as ass_bal from {line_base} group by dt, pty_id, ccy"""

INPUTS["vw_ms_cust_fc_tran_idx_d"] = """
select dt as data_dt, pty_id, case when rf = 'A' then amt else 0 * amt end as assure_in_amt,
       case when rf = 'R' then amt else 0 * amt end as assure_out_amt from {line_base} where ln < 5"""

INPUTS["vw_ms_cust_fc_fin_idx_d"] = """
select dt as data_dt, pty_id, case when rf = 'N' then amt else 0 * amt end as cash_in,
       case when rf = 'A' then amt else 0 * amt end as cash_out from {line_base} where ln >= 5"""

INPUTS["ms_cust_fin_d"] = """
select dt as data_dt, pty_id, case when ln = 1 then amt else 0 * amt end as cash_in,
       case when ln = 2 then amt else 0 * amt end as tran_in, case when ln = 3 then amt else 0 * amt end as assign_in,
       case when rf = 'A' then qty else 0 * qty end as lmt_in_amt, case when ln = 4 then amt else 0 * amt end as cash_out,
       case when ln = 5 then amt else 0 * amt end as tran_out, case when ln = 6 then amt else 0 * amt end as assign_out
from {line_base}"""

# --- journals --------------------------------------------------------------

INPUTS["sta_fc_jnls"] = f"""
select dt as data_dt, pty_id, prdt_id as stk_id, ccy,
       case mod(ok + ln * 3, {len(_JOURNAL_CODES)}) {_CODE} end as busi_cd,
       case when mod(ok, 2) = 0 then '603010' else '603020' end as tran_dir_cd, amt as barg_amt, qty as barg_cnt,
       tax + disc as ent_pri, cast(amt * tax as decimal(14,4)) as rake, cast(amt * disc as decimal(14,4)) as pur_rake,
       tax as fare1, disc as fare2, case when ln > 3 then tax end as fare3, case when rf = 'A' then disc end as farex
from {{line_base}}"""

INPUTS["sta_stk_jnls"] = """
select dt as data_dt, pty_id, case ln when 7 then 'HG204001' when 6 then '131800' else prdt_id end as stk_id, ccy,
       case ln when 1 then '406004034' when 2 then '406004021' when 3 then '406004022' when 4 then '406004121'
               when 5 then '406002434' when 6 then '406004105' else '406004103' end as busi_cd,
       amt as barg_amt, cast(amt * disc as decimal(14,4)) as clear_balance
from {line_base}"""

INPUTS["sta_fund_jnls"] = """
select dt as data_dt, pty_id, case when ln < 6 then 'TA940018' else 'TA000001' end as fund_id, ccy,
       case rf when 'A' then '406000143' when 'R' then '406000142' else '406000150' end as busi_cd, qty as barg_cnt
from {line_base}"""

_CORE = """pty_id, sys as sys_source_cd, case when ln = 4 and rf = 'N' then 'HG131800' else prdt_id end as prdt_id,
       case when rf = 'A' then amt else 0 * amt end as buy_amt, case when rf = 'R' then amt else 0 * amt end as sell_amt,
       cast(amt * tax as decimal(14,4)) as buy_rake, cast(amt * disc as decimal(14,4)) as sell_rake,
       case when ls = 'F' then tax end as buy_fare, case when ls = 'O' then disc end as sell_fare,
       case when rf = 'A' then ln else 0 end as buy_cnt, case when rf = 'R' then ln else 0 end as sell_cnt"""
INPUTS["mf_cust_tran_core_m"] = f"select mdt as data_dt, {_CORE} from {{line_base}}"
INPUTS["mf_cust_tran_core_d"] = f"select dt as data_dt, {_CORE} from {{line_base}}"

INPUTS["mf_cust_sys_fin_d"] = """
select dt as data_dt, pty_id, sys as sys_source_cd, prdt_id, ccy, cast(amt * disc as decimal(14,4)) as tran_in,
       cast(amt * tax as decimal(14,4)) as tran_out, cast(qty as decimal(12,2)) as allot_share_amt,
       cast(disc as decimal(12,2)) as bonus_amt from {line_base}"""

# --- positions -------------------------------------------------------------

INPUTS["ms_cust_ccy_prdt_anahold_d"] = """
select mdt as data_dt, pty_id, sys as sys_source_cd,
       case when ln = 1 and ls = 'F' then 'ZQ888880' else prdt_id end as prdt_id, min(ccy) as ccy,
       cast(min(dt) - interval '12' day as date) as hold_dt, cast(sum(amt) as decimal(14,2)) as mkt_val
from {line_base} where ln <> 6
group by mdt, pty_id, sys, case when ln = 1 and ls = 'F' then 'ZQ888880' else prdt_id end"""

INPUTS["ms_cust_ccy_prdt_anaunhold_d"] = """
select dt as data_dt, pty_id, sys as sys_source_cd, prdt_id, cast(ln * 4 as int) as hold_days from {line_base} where rf = 'R'"""

INPUTS["ms_cust_prdt_fc_hold_d"] = """
select data_dt, pty_id, prdt_id, cast(sum(qty) - min(qty) as decimal(14,0)) as hold_cnt,
       cast(sum(case when rf = 'A' then qty else 0 end) as decimal(14,0)) as deb_mnt,
       cast(sum(case when rf = 'R' then qty else 0 end) as decimal(14,0)) as stc_deb_mnt,
       cast(sum(amt) as decimal(14,2)) as mkt_val, cast(sum(amt * disc) as decimal(16,4)) as deb_int_d,
       cast(min(data_dt) - interval '40' day as date) as hold_dt
from (select case when ln < 6 then mdt else dt end as data_dt, pty_id, prdt_id, qty, amt, disc, rf from {line_base}
      where ls = 'F') as x
group by data_dt, pty_id, prdt_id"""

INPUTS["ms_cust_prdt_fc_unhold_d"] = """
select dt as data_dt, pty_id, prdt_id, cast(ln * 3 as int) as hold_days from {line_base} where rf = 'N' and ls = 'F'"""
INPUTS["ms_cust_prdt_hold_d"] = "select distinct mdt as data_dt, pty_id, prdt_id from {line_base} where ls = 'O'"
INPUTS["ms_cust_prdt_unhold_d"] = "select dt as data_dt, pty_id, prdt_id from {line_base} where ls = 'O' and rf = 'R'"

# --- the monthly report's own inputs --------------------------------------

INPUTS["sta_gti_mkt_pnt"] = """
select cast(o_orderdate as date) as data_dt, '000001' as mkt_type_cd,
       case when extract(day from cast(o_orderdate as date)) > 28 then null
            else max(cast(o_totalprice as decimal(12,2))) end as end_price
from {orders} group by cast(o_orderdate as date)"""

INPUTS["sta_port_simulationinfo"] = """
select 1 as portid, cast(o_orderdate as date) as pubdate, cast(sum(cast(o_totalprice as decimal(12,2))) as decimal(18,2)) as capitaltotal,
       cast(100000 as decimal(18,2)) as fundsizefirst
from {orders} group by cast(o_orderdate as date)"""

INPUTS["ms_cust_char_io_aset_m"] = """
select mdt as data_dt, pty_id, cast(sum(case when rf = 'A' then amt else 0 end) as decimal(18,2)) as in_aset_m,
       cast(sum(case when rf = 'R' then amt else 0 end) as decimal(18,2)) as out_aset_m,
       cast(max(amt) as decimal(18,2)) as max_cost_aset_m
from {line_base} where ln < 4 group by mdt, pty_id"""
INPUTS["ms_cust_char_aset_m"] = """
select mdt as data_dt, pty_id, cast(max(disc) as decimal(8,4)) as avg_aset_scale_m from {line_base} group by mdt, pty_id"""
INPUTS["ms_cust_char_tran_m"] = """
select mdt as data_dt, pty_id, count(*) as stk_tran_cnt_m from {line_base} where rf = 'A' group by mdt, pty_id"""
INPUTS["ms_cust_char_rank_m"] = """
select date '1998-06-30' as data_dt, concat('C', cast(s_suppkey as string)) as pty_id,
       case when s_nationkey < 20 then '809050' else '809051' end as char_id, cast(s_nationkey as string) as char_value, 1 as rank
from {supplier}"""
INPUTS["ms_cust_char_obj_h"] = """
select concat('C', cast(s_suppkey as string)) as pty_id, cast(mod(s_suppkey, 25) as string) as risk_habit_cd2,
       date '1996-01-01' as bgn_dt, date '2999-12-31' as end_dt from {supplier} where s_acctbal > 1000"""
INPUTS["ms_cust_zl_cost_m"] = """
select mdt as data_dt, pty_id, cast(sum(case when rf = 'A' then amt else -amt end) as decimal(18,2)) as aset_pft
from {line_base} where ln < 3 group by mdt, pty_id"""
