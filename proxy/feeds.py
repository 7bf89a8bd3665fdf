"""Market feeds derived from the driver tables, in each raw format."""

from proxy.core import INPUTS

_LINE_TS = "<<ADDSEC l_shipdate ; cast(34200 + mod(l_orderkey * 7 + l_linenumber * 11, 19800) as int)>>"
_ORDER_TS = "<<ADDSEC o_orderdate ; cast(33000 + mod(o_orderkey * 13, 21600) as int)>>"
_LEVELS = range(1, 11)


def _id(column: str) -> str:
    return f"lpad(cast({column} as string), 6, '0')"


INPUTS["products_csv"] = f"""
select concat({_id('p_partkey')}, case when p_size > 45 then '.SH' else '.SZ' end) as prdtid,
       case p_type when 'MEDIUM' then '3' when 'STANDARD' then '4' else '2' end as sectype,
       case when p_brand = 'Brand#1' then '-' else substring(p_brand, 7, 2) end as secsubtype,
       case when p_name like 'red%' then '-' else p_name end as symbol
from {{part}}"""

INPUTS["products_sz"] = """
select substring(prdtid, 1, 6) as prdtid, sectype, secsubtype, symbol
from {products_csv} where prdtid like '%.SZ'"""

INPUTS["products_sh"] = """
select substring(prdtid, 1, 6) as prdtid, sectype, secsubtype, symbol
from {products_csv} where prdtid like '%.SH'"""

# --- trades and orders -----------------------------------------------------

INPUTS["trade_base"] = f"""
select {_id('l_partkey')} as securityid, {_LINE_TS} as ts, l_orderkey * 10 + l_linenumber as seq,
       l_orderkey as bid, l_suppkey * 150 as offer, l_returnflag as flag, l_linestatus as status,
       case when l_discount = 0 then 0.0 else l_extendedprice end as price, cast(l_quantity as bigint) as qty
from {{lineitem}}"""

INPUTS["raw_trade"] = """
select securityid, <<TS17 ts>> as origtime, 'M1' as mdstreamid, seq as applseqnum, bid as bidapplseqnum,
       offer as offerapplseqnum, case when flag = 'A' then '4' else 'F' end as exectype, price, qty as tradeqty
from {trade_base}"""

INPUTS["raw_trade_old"] = """
select securityid, <<DAY8 ts>> as tradedate, <<CLOCK ts>> as tradetime, seq as recno,
       concat(cast(bid as string), ' ') as buyorderrecno, cast(offer as string) as sellorderrecno,
       case when flag = 'A' then 'C' else '0 ' end as functioncode,
       case when status = 'F' and flag = 'A' then '2' else '0' end as orderkind, price, qty as tradeqty
from {trade_base}"""

INPUTS["raw_trade_sh"] = """
select securityid, concat(<<TS14 ts>>, lpad(cast(mod(seq, 100) as string), 2, '0')) as tradetime,
       cast(cast(price as decimal(12,2)) as string) as price, cast(qty as string) as tradeqty,
       cast(cast(cast(price as decimal(12,2)) * qty as decimal(18,2)) as string) as tradeamount,
       cast(bid as string) as bidapplseqnum, cast(offer as string) as offerapplseqnum
from {trade_base}
union all
select 'HEAD:v1', '', '', '', '', '', ''"""

INPUTS["order_base"] = f"""
select {_id('o_custkey')} as securityid, {_ORDER_TS} as ts, o_orderkey as seq, o_orderstatus as status,
       substring(o_orderpriority, 1, 1) as priority, o_totalprice as total,
       cast(floor(o_totalprice / 100) as bigint) as qty
from {{orders}}"""

INPUTS["raw_order"] = """
select securityid, <<TS17 ts>> as origtime, 'M2' as mdstreamid, seq as applseqnum,
       case priority when '1' then 'U' when '2' then '1' else '2' end as ordertype,
       case status when 'F' then '1' when 'O' then 'F' else 'G' end as side,
       case when priority = '5' then -1.0 else total end as price, qty as orderqty,
       cast(priority as int) as expirationtype, 30 as expirationdays,
       case when status = 'P' then 'NULL' else concat('T', priority) end as contactor,
       case when status = 'F' then 'NULL' else 'desk' end as contactinfo, cast(seq as string) as confirmid
from {order_base}"""

INPUTS["raw_order_old"] = """
select securityid, <<DAY8 ts>> as tradedate, <<CLOCK ts>> as orderentrytime, seq as recno,
       case when priority = '5' then -1.0 else total end as price, qty as orderqty,
       case status when 'F' then 'B ' when 'O' then 'S' else 'C' end as functioncode,
       case priority when '1' then '0' when '2' then 'X' when '3' then 'Y' when '4' then 'V' else 'Q' end as orderkind
from {order_base}"""

# --- index ticks -----------------------------------------------------------

INPUTS["raw_index"] = """
select lpad(cast(user_id as string), 6, '0') as securityid, '102' as securityidsource, <<TS17 ts>> as origtime,
       'M3' as mdstreamid,
       case event_type when 'signup' then 'S0' when 'purchase' then 'T0 ' when 'view' then 'B0'
                       when 'click' then 'C1' else 'ZZ' end as tradingphasecode,
       value + 1 as preclosepx, value as lastpx, value as openpx, value * 2 as highpx,
       cast(value as string) as lowpx, cast(floor(value * 10) as bigint) as totalvolumetrade,
       value * 3 - 20 as totalvaluetrade
from {events}"""

INPUTS["raw_index_old"] = """
select lpad(cast(user_id as string), 6, '0') as securityid, <<DAY8 ts>> as tradedate, <<CLOCK ts>> as datatimestamp,
       value + 1 as closeindex, value as openindex, value * 2 as highindex, value as lowindex, value as lastindex,
       value * 3 as turnover, cast(floor(value * 10) as bigint) as totalvolumetraded, event_id as numtrades
from {events}"""

# --- snapshots and books ---------------------------------------------------

_PRICES = """total as preclosepx, total * 1.0 as openpx,
       case when priority = '1' then total - 1 else total + 5 end as highpx,
       case when priority = '2' then total + 1 else total - 5 end as lowpx,
       case when priority = '3' then 0.0 else total end as lastpx"""

INPUTS["raw_snap"] = f"""
select securityid, 'M4' as mdstreamid, <<DAY8 ts>> as tradedate, <<TS17 ts>> as origtime, {_PRICES},
       1.5 as pxchange1, 2.5 as pxchange2, mod(seq, 977) as numtrades, qty as totalvolumetrade,
       total * 10 as totalvaluetrade, total + 2 as uplimitpx,
       case when status = 'O' then total + 1 else total - 2 end as downlimitpx,
       concat(cast(qty as string), '.50') as totalofferqty, cast(qty as string) as totalbidqty,
       total as weightedavgbidpx, total as weightedavgofferpx, 10.5 as peratio1, 11.5 as peratio2,
       case status when 'F' then 'T0' when 'O' then 'E1' else 'V' end as tradingphasecode,
       0.0 as warrantpremiumrate, total / 2 as prenav, case when priority = '4' then 'NULL' else '1.234' end as realtimenav
from {{order_base}}"""

INPUTS["raw_snap_old"] = f"""
select securityid, <<DAY8 ts>> as tradedate, <<CLOCK ts>> as datatimestamp, {_PRICES},
       mod(seq, 977) as numtrades, qty as totalvolumetrade, total * 10 as totalvaluetrade,
       qty as totalofferqty, qty + 1 as totalbidqty, total as weightedavgbidpx, total as weightedavgofferpx,
       10.5 as peratio1, 11.5 as peratio2
from {{order_base}}"""


def _level(side: str, i: int) -> str:
    """Levels 1-7 come from the order's lines; two lines on one level keep the dearer."""
    if i > 7:
        return f"0.0 as {side}px{i}, cast(0 as bigint) as {side}size{i}"
    status = "O" if side == "bid" else "F"
    mine = f"l_linenumber = {i} and l_linestatus = '{status}'"
    sign = "20000 -" if side == "bid" else "20000 +"
    price = f"{sign} {i} * 100 + floor(l_extendedprice / 700)"
    return (
        f"coalesce(max(case when {mine} then {price} end), 0.0) as {side}px{i}, "
        f"coalesce(max(case when {mine} then cast(l_quantity as bigint) - 3 end), 0) as {side}size{i}"
    )


_BOOK = ",\n       ".join(_level(side, i) for side in ("bid", "offer") for i in _LEVELS)
_BOOK_NAMES = ", ".join(f"b.{side}{what}{i}" for side in ("bid", "offer") for i in _LEVELS for what in ("px", "size"))
_QUEUE = """b.numorders_b1, b.noorders_b1, b.orderqty_b1, b.numorders_b1 as numorders_s1,
       b.noorders_b1 as noorders_s1, b.orderqty_b1 as orderqty_s1"""

INPUTS["book_base"] = f"""
select l_orderkey, {_BOOK},
       count(*) as numorders_b1, count(*) as noorders_b1,
       case when count(*) > 3 then concat(cast(count(*) as string), '|', cast(min(l_linenumber) as string), '|7')
            else ' ' end as orderqty_b1
from {{lineitem}} group by l_orderkey"""

INPUTS["raw_snap_level"] = f"""
select o.securityid, <<TS17 o.ts>> as origtime, {_BOOK_NAMES}, {_QUEUE}
from {{order_base}} o join {{book_base}} b on o.seq = b.l_orderkey"""

INPUTS["raw_snap_level_old"] = f"""
select o.securityid, <<DAY8 o.ts>> as tradedate, <<CLOCK o.ts>> as datatimestamp, o.seq as sendtime,
       {_BOOK_NAMES}, {_QUEUE}
from {{order_base}} o join {{book_base}} b on o.seq = b.l_orderkey"""

_SH_BOOK = ", ".join(
    f"cast(cast(b.bidpx{i} as decimal(12,2)) as string) as bidpx{i}, cast(b.bidsize{i} as string) as bid{i}orderqty, "
    f"'{i}' as bid{i}numorders, cast(cast(b.offerpx{i} as decimal(12,2)) as string) as offer{i}price, "
    f"cast(b.offersize{i} as string) as offer{i}orderqty, '{i}' as offer{i}numorders"
    for i in _LEVELS
)
_SH_QUEUE = ", ".join(
    (f"cast(b.bidsize{i} as string) as bid1orders{i}, cast(b.offersize{i} as string) as offer1orders{i}"
     if i <= 10 else f"'' as bid1orders{i}, '0' as offer1orders{i}")
    for i in range(1, 51)
)
_SH_TOTALS = ", ".join(
    f"cast(o.qty as string) as {c}" for c in (
        "totalbidnumber", "totaloffernumber", "bidtrademaxduration", "offertrademaxduration", "numbidorders",
        "numofferorders", "withdrawbuynumber", "withdrawbuyamount", "withdrawbuymoney", "withdrawsellnumber",
        "withdrawsellamount", "withdrawsellmoney",
    )
)
_TOTAL_TEXT = "cast(cast(o.total as decimal(12,2)) as string)"
INPUTS["raw_snap_sh"] = f"""
select o.securityid, <<TS14 o.ts>> as datetime, {_TOTAL_TEXT} as preclosepx, {_TOTAL_TEXT} as openpx,
       {_TOTAL_TEXT} as highpx, {_TOTAL_TEXT} as lowpx, {_TOTAL_TEXT} as lastpx,
       cast(mod(o.seq, 977) as string) as numtrades, cast(o.qty as string) as totalvolumetrade,
       {_TOTAL_TEXT} as totalvaluetrade, cast(o.qty as string) as totalbidqty, cast(o.qty as string) as totalofferqty,
       {_TOTAL_TEXT} as weightedavgbidpx, {_TOTAL_TEXT} as weightedavgofferpx, {_SH_TOTALS},
       case o.status when 'F' then 'TRADE' when 'O' then 'VOLA ' else 'NOPE' end as instrumentstatus, '1.5' as iopv,
       {_SH_BOOK}, {_SH_QUEUE}
from {{order_base}} o join {{book_base}} b on o.seq = b.l_orderkey"""


# --- the same feeds as stored tables hold them: time columns already typed -----

for _feed in ("trade", "order", "index", "snap", "snap_level"):
    for _suffix in ("", "_old"):
        _sql = INPUTS[f"raw_{_feed}{_suffix}"]
        _ts = "o.ts" if "o.ts" in _sql else "ts"
        _stamp = f"<<TS17 {_ts}>> as origtime" if not _suffix else f"<<DAY8 {_ts}>> as tradedate"
        assert _stamp in _sql
        INPUTS[f"typed_{_feed}{_suffix}"] = _sql.replace(
            _stamp, f"{_ts}, cast({_ts} as date) as trade_date, <<CLOCK {_ts}>> as clock, {_stamp}"
        )


# --- what the oracle side reads: the raw feeds in SQL, normalized ----------

def _plain(name: str, source: str, ts: str, clock: str) -> None:
    INPUTS[name] = f"select *, cast({ts} as date) as trade_date, {ts} as ts, {clock} as clock from ({source}) as _raw"


def _stamp17(c: str) -> str:
    return f"strptime({c}, '%Y%m%d%H%M%S%g')"


def _clock17(c: str) -> str:
    return f"cast(substring({c}, 9, 9) as bigint)"


for _feed in ("trade", "order", "index", "snap", "snap_level"):
    _plain(f"sql_{_feed}", f"select * from {{raw_{_feed}}}", _stamp17("origtime"), _clock17("origtime"))

for _feed, _raw in (("trade", "tradetime"), ("order", "orderentrytime"), ("index", "datatimestamp"),
                    ("snap", "datatimestamp"), ("snap_level", "datatimestamp")):
    _text = f"concat(substring(tradedate, 1, 8), lpad(cast({_raw} as varchar), 9, '0'))"
    _plain(f"sql_{_feed}_old", f"select * from {{raw_{_feed}_old}}", _stamp17(_text), _raw)

_plain("sql_trade_sh", "select * from {raw_trade_sh} where securityid <> 'HEAD:v1'",
       "strptime(concat(substring(tradetime, 1, 14), '0', substring(tradetime, 15, 2)), '%Y%m%d%H%M%S%g')",
       "cast(concat(substring(tradetime, 9, 6), '0', substring(tradetime, 15, 2)) as bigint)")
_plain("sql_snap_sh", "select * from {raw_snap_sh}", "strptime(datetime, '%Y%m%d%H%M%S')",
       "cast(concat(substring(datetime, 9, 6), '000') as bigint)")

# the serving side of the reconciliation: every stored trade, a third of them
# under another number than in the file
INPUTS["store_trade"] = """
select securityid, ts, cast(ts as date) as trade_date,
       seq + case when flag = 'N' then 1000000000 else 0 end as applseqnum, price, qty
from {trade_base}"""

# ticks with a falling value, a falling volume and a step that repeats
INPUTS["sql_ticks"] = """
select cast(user_id as string) as securityid, cast(ts as date) as trade_date, event_id as applseqnum, value,
       cast(floor(value) as bigint) as volume, cast(floor(event_id / 500) as bigint) as step
from {events}"""

# day totals per security that are near the sum of the day's executed trades
INPUTS["sql_totals"] = """
select securityid, cast(ts as date) as trade_date, sum(qty) + 0 as totalvolumetrade,
       cast(sum(cast(price as decimal(12,2)) * qty) as double) as totalvaluetrade
from {trade_base} group by securityid, cast(ts as date)"""

INPUTS["sql_blanks"] = """
select cast(ts as date) as trade_date, case when status = 'P' then null when priority = '1' then ' ' else 'x' end as contact,
       case when status = 'F' then '' else 'desk' end as desk,
       case when priority = '2' then 'NaN' else cast(qty as string) end as total
from {order_base}"""

# the events as trades: thirty days, so thirty partitions where a table is stored
INPUTS["raw_trade_ticks"] = """
select lpad(cast(user_id as string), 6, '0') as securityid, <<TS17 ts>> as origtime, 'M5' as mdstreamid,
       event_id as applseqnum, mod(event_id * 7, 1000) as bidapplseqnum, mod(event_id * 3, 1000) as offerapplseqnum,
       case when event_type = 'error' then '4' else 'F' end as exectype,
       case when event_type = 'click' then 0.0 else value end as price, cast(floor(value * 3) as bigint) as tradeqty
from {events}"""
_plain("sql_trade_ticks", "select * from {raw_trade_ticks}", _stamp17("origtime"), _clock17("origtime"))
