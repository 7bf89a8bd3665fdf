"""Queries over the derived market feeds: keys, codes, rules, cleaning,
publishing, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proxy.core import query
from quotewell.functions import arrays, codes, keys, numbers, times
from quotewell.operators import bitmaps, clean, relational, rules, volumes
from quotewell.plans import publish, recon
from quotewell.session import scratch_dir
from quotewell.sources import readers, schemas, sinks

KEY3 = ["securityid", "ts", "applseqnum"]


def raw_feed(t, name: str, fmt: str = "new") -> DataFrame:
    """A feed as its files hold it, parsed."""
    return readers.normalize(t[f"raw_{name}" if fmt == "new" else f"raw_{name}_{fmt}"], name, fmt)


def feed(t, name: str, fmt: str = "new") -> DataFrame:
    """A feed as its stored table holds it: times typed when it was loaded."""
    if fmt == "sh":
        return raw_feed(t, name, fmt)
    return readers.typed_columns(t[f"typed_{name}" if fmt == "new" else f"typed_{name}_{fmt}"], name, fmt)


# --- reconcile -------------------------------------------------------------

_RECON_COUNTS = """
select {by} securityid, ts, applseqnum, sum(f) as n_file, sum(s) as n_store from (
  select trade_date, securityid, ts, applseqnum, 1 as f, 0 as s from {{sql_trade}} {where}
  union all
  select trade_date, securityid, ts, applseqnum, 0, 1 from {{store_trade}} {where}) as both_sides
group by {by} securityid, ts, applseqnum"""
_RECON_SUMS = """
coalesce(sum(n_store), 0) as n_store, coalesce(sum(n_file), 0) as n_file,
count(*) filter (where n_file > 0 and n_store > 0) as n_common,
coalesce(sum(case when n_store = 0 then n_file end), 0) as n_file_only,
coalesce(sum(case when n_file = 0 then n_store end), 0) as n_store_only,
case when count(*) filter (where n_file > 0 and n_store > 0) > 0 then 'OK' else 'CHECK' end as status"""


@query("recon_summary", "n_store:i n_file:i n_common:i n_file_only:i n_store_only:i status:s",
       f"select {_RECON_SUMS} from ({_RECON_COUNTS.format(by='', where='')}) as c")
def recon_summary(t):
    return recon.summary(recon.key_counts(feed(t, "trade"), t["store_trade"], KEY3))


@query("recon_sessions_by_day",
       "trade_date:s n_store:i n_file:i n_common:i n_file_only:i n_store_only:i status:s",
       f"select trade_date, {_RECON_SUMS} from ("
       + _RECON_COUNTS.format(by="trade_date,", where="where hour(ts) * 100 + minute(ts) between 900 and 1129 or "
                              "(hour(ts) = 11 and minute(ts) = 30 and second(ts) = 0) or "
                              "hour(ts) * 100 + minute(ts) between 1300 and 1459 or "
                              "(hour(ts) = 15 and minute(ts) = 0 and second(ts) = 0)")
       + ") as c group by trade_date")
def recon_sessions_by_day(t):
    counts = recon.key_counts(
        feed(t, "trade"), t["store_trade"], ["trade_date", *KEY3], times.FULL_SESSIONS, scope="all"
    )
    return recon.summary(counts, ["trade_date"])


@query("recon_file_only_rows", "securityid:s origtime:s applseqnum:i price:d tradeqty:i", """
select securityid, origtime, applseqnum, price, tradeqty from {sql_trade} t
where not exists (select 1 from {store_trade} s where s.securityid = t.securityid and s.ts = t.ts
                  and s.applseqnum = t.applseqnum)""")
def recon_file_only_rows(t):
    return relational.missing_from(feed(t, "trade"), t["store_trade"], KEY3)


@query("recon_store_only_keys", "securityid:s applseqnum:i", """
select securityid, applseqnum from {store_trade} s
where not exists (select 1 from {sql_trade} t where s.securityid = t.securityid and s.ts = t.ts
                  and s.applseqnum = t.applseqnum)""")
def recon_store_only_keys(t):
    return recon.one_sided(recon.key_counts(feed(t, "trade"), t["store_trade"], KEY3), "store")


# --- keys, codes, scalar expressions ---------------------------------------

_KEY = "concat(substring(md5({id}), 1, 6), {id}, cast(9223372036854775807 - epoch_us({ts}) // 1000 as varchar))"
_SEQ = ", cast(9223372036854775807 - {seq} as varchar))"


def _sql_key(full: str, ts: str = "ts", seq: str | None = None) -> str:
    key = _KEY.format(id=full, ts=ts)
    return key if seq is None else key[:-1] + _SEQ.format(seq=seq)


@query("row_key_events", "event_id:i row_key:s row_key_seq:s",
       f"select event_id, {_sql_key('id')} as row_key, {_sql_key('id', seq='event_id')} as row_key_seq "
       "from (select *, concat(cast(user_id as varchar), '.SZ') as id from {events}) as e")
def row_key_events(t):
    full = F.concat(F.col("user_id").cast("string"), F.lit(".SZ"))
    return t["events"].select(
        "event_id", keys.row_key(full, F.col("ts")).alias("row_key"),
        keys.row_key(full, F.col("ts"), F.col("event_id")).alias("row_key_seq"),
    )


@query("row_key_round_trip", "event_id:i ms:i", "select event_id, epoch_us(ts) // 1000 as ms from {events}")
def row_key_round_trip(t):
    full = F.concat(F.col("user_id").cast("string"), F.lit(".HK"))
    keyed = t["events"].select("event_id", full.alias("id"), keys.row_key(full, F.col("ts"), F.col("event_id")).alias("k"))
    return keyed.select("event_id", times.epoch_ms(keys.key_time(F.col("k"), F.col("id"))).alias("ms"))


_PHASES = {**codes.PHASE_SZ}
_PHASE_SQL = (
    "case when cast(floor(clock / 100000) as bigint) between 1130 and 1300 then '4' "
    "when cast(floor(clock / 100000) as bigint) between 925 and 930 then '2' else (case trim({c}) "
    + " ".join(f"when '{k}' then '{v}'" for k, v in _PHASES.items()) + " end) end"
)
_INDEX_PHASE_SQL = _PHASE_SQL.replace("when 'B0' then '4' ", "")


@query("phase_map_session", "securityid:s origtime:s phase:s index_phase:s in_session:i",
       f"select securityid, origtime, {_PHASE_SQL.format(c='tradingphasecode')} as phase, "
       f"{_INDEX_PHASE_SQL.format(c='tradingphasecode')} as index_phase, "
       "case when clock between 90000000 and 113000000 or clock between 130000000 and 150000000 then 1 else 0 end "
       "as in_session from {sql_index}")
def phase_map_session(t):
    code, clock = F.col("tradingphasecode"), F.col("clock")
    return feed(t, "index").select(
        "securityid", "origtime", codes.phase_sz(code, clock).alias("phase"),
        codes.phase_sz(code, clock, index=True).alias("index_phase"),
        times.in_sessions(clock).alias("in_session"),
    )


@query("code_maps", "seq:i order_type:s order_type_old:s side_store:s side_lending:s side_old:s rejected:i", """
select n.applseqnum as seq, case when n.ordertype = 'U' then '3' else n.ordertype end as order_type,
  case o.orderkind when '0' then '2' when 'X' then '3' when 'Y' then '4' when '2' then '5' when 'V' then '6'
                   when 'W' then '7' end as order_type_old,
  case n.side when '1' then '1' when 'G' then '1' when '2' then '2' when 'F' then '2' end as side_store,
  case n.side when 'G' then '3' when 'F' then '4' else n.side end as side_lending,
  case trim(o.functioncode) when 'B' then '1' when 'C' then '5' when 'S' then '2' end as side_old,
  case when o.orderkind in ('0', 'X', 'Y', '2', 'V', 'W') then 0 else 1 end as rejected
from {raw_order} n join {raw_order_old} o on n.applseqnum = o.recno""")
def code_maps(t):
    both = t["raw_order"].join(
        t["raw_order_old"].select(F.col("recno").alias("applseqnum"), "functioncode", "orderkind"), "applseqnum"
    )
    old = codes.order_type_old(F.col("orderkind"))
    return both.select(
        F.col("applseqnum").alias("seq"), codes.order_type_new(F.col("ordertype")).alias("order_type"),
        old.alias("order_type_old"), codes.side_new(F.col("side")).alias("side_store"),
        codes.side_new(F.col("side"), "lending").alias("side_lending"),
        codes.side_old(F.col("functioncode")).alias("side_old"),
        codes.is_unmapped(F.col("orderkind"), old).alias("rejected"),
    )


_NEW_FLAGS = f"""select trade_date, {_sql_key("concat(securityid, '.SZ')", seq='applseqnum')} as row_key,
  max(case when bidapplseqnum > offerapplseqnum then '1' else '2' end) as flag
from {{sql_trade}} where price <> 0 and tradeqty <> 0 and bidapplseqnum <> offerapplseqnum group by 1, 2"""


@query("bs_flag_revision", "row_key:s TradeBSFlag:s", f"""
select s.row_key, coalesce(n.flag, '0') as TradeBSFlag
from (select {_sql_key("concat(securityid, '.SZ')", seq='applseqnum')} as row_key from {{sql_trade}}) s
left join ({_NEW_FLAGS}) n on s.row_key = n.row_key""")
def bs_flag_revision(t):
    trades = feed(t, "trade")
    full = F.concat("securityid", F.lit(".SZ"))
    stored = trades.select(
        "trade_date", keys.row_key(full, F.col("ts"), F.col("applseqnum")).alias("row_key"),
        F.lit("0").alias("TradeBSFlag"),
    )
    revised = recon.revised_flags(trades)
    return relational.partial_upsert(stored, revised, ["trade_date", "row_key"], ["TradeBSFlag"])


@query("trade_money", "l_orderkey:i l_linenumber:i money:d half:d", """
select l_orderkey, l_linenumber, cast(l_extendedprice as decimal(20,6)) * cast(l_quantity as decimal(10,0)) as money,
  round_even(l_quantity / 16, 3) as half
from {lineitem}""")
def trade_money(t):
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber",
        numbers.trade_money(F.col("l_extendedprice"), F.col("l_quantity")).alias("money"),
        numbers.trade_money(F.col("l_quantity") / 16, F.lit(1)).alias("half"),
    )


@query("order_queue_lists", "securityid:s origtime:s queued:d total:d", """
select securityid, origtime, case when trim(orderqty_b1) <> '' then len(string_split(trim(orderqty_b1), '|')) end as queued,
  case when trim(orderqty_b1) <> '' then list_sum(list_transform(string_split(trim(orderqty_b1), '|'),
    lambda x: cast(x as double))) end as total
from {raw_snap_level}""")
def order_queue_lists(t):
    queue = arrays.pipe_list(F.col("orderqty_b1"))
    return t["raw_snap_level"].select(
        "securityid", "origtime", F.when(queue.isNotNull(), F.size(queue)).alias("queued"),
        F.aggregate(queue, F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


_NONZERO = " + ".join(f"(case when try_cast(bid1orders{i} as double) <> 0 then 1 else 0 end)" for i in range(1, 51))
_NONZERO_SUM = " + ".join(f"coalesce(try_cast(bid1orders{i} as double), 0)" for i in range(1, 51))


@query("nonzero_queue", "securityid:s datetime:s queued:i total:d",
       f"select securityid, datetime, {_NONZERO} as queued, {_NONZERO_SUM} as total from {{raw_snap_sh}}")
def nonzero_queue(t):
    queue = arrays.nonzero_list([F.col(f"bid1orders{i}") for i in range(1, schemas.QUEUE + 1)])
    return t["raw_snap_sh"].select(
        "securityid", "datetime", F.size(queue).alias("queued"),
        F.aggregate(queue, F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


@query("threshold_sums", "sum_above:d sum_upto:d", """
select sum(case when v > 70000 then v end) as sum_above, sum(case when v <= 70000 then v end) as sum_upto
from (select cast(l_extendedprice as decimal(12,2)) as v from {lineitem}) as x""")
def threshold_sums(t):
    v = t["lineitem"].select(F.col("l_extendedprice").cast("decimal(12,2)").alias("v"))
    return relational.threshold_sums(v, "v", 70000)


@query("conditional_sums", "l_suppkey:i sold:d kept:d returned:d n_kept:i", """
select l_suppkey, sum(case when l_returnflag in ('A', 'N') then v else 0 end) as sold,
  sum(case when l_returnflag = 'N' then v else 0 end) as kept,
  sum(case when l_returnflag = 'R' then v else 0 end) as returned,
  sum(case when l_returnflag = 'N' then 1 else 0 end) as n_kept
from (select *, cast(l_extendedprice as decimal(12,2)) as v from {lineitem}) as x group by l_suppkey""")
def conditional_sums(t):
    v = F.col("l_extendedprice").cast("decimal(12,2)")
    return t["lineitem"].groupBy("l_suppkey").agg(*relational.conditional_sums(F.col("l_returnflag"), {
        "sold": (("A", "N"), v), "kept": ("N", v), "returned": ("R", v), "n_kept": ("N", 1),
    }))


@query("synthetic_sequence", "securityid:s tradetime:s applseqnum:i bidapplseqnum:i tradeqty:i", """
select securityid, tradetime, cast(bidapplseqnum as bigint) as bidapplseqnum, cast(tradeqty as bigint) as tradeqty,
  row_number() over (partition by trade_date, securityid order by ts, tradetime, cast(price as double),
    cast(tradeqty as bigint), cast(tradeamount as double), cast(bidapplseqnum as bigint),
    cast(offerapplseqnum as bigint)) as applseqnum
from {sql_trade_sh}""")
def synthetic_sequence(t):
    return publish.number_sh_trades(feed(t, "trade", "sh"))


@query("keep_latest", "user_id:i event_id:i event_type:s value:d", """
select user_id, event_id, event_type, value from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as n from {events}
) as x where n = 1""")
def keep_latest(t):
    return relational.keep_latest(t["events"], ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


@query("scan_store", "event_id:i user_id:i", """
select event_id, user_id from {events}
where ts between timestamp '2024-01-05 09:00:00' and timestamp '2024-01-12 15:00:00'
  and user_id in (select user_id from {events} where event_type = 'purchase')""")
def scan_store(t):
    ids = t["events"].where("event_type = 'purchase'").select("user_id").distinct()
    return readers.scan_store(t["events"], "2024-01-05 09:00:00", "2024-01-12 15:00:00", ids, security="user_id")


@query("scan_store_clustered", "event_id:i user_id:i", """
select event_id, user_id from {events}
where (ts between timestamp '2024-01-05 09:00:00' and timestamp '2024-01-12 15:00:00' and user_id between 3 and 7) or event_id in (17, 517, 917)""")
def scan_store_clustered(t):
    """Range scans of a store clustered by security and time, and look-ups of single ids by Bloom filter."""
    path = scratch_dir(t.spark, "clustered")
    rows = t["events"].withColumn("trade_date", F.to_date("ts"))
    sinks.write_clustered(rows, path, ("user_id", "ts"), {"event_id": 100_000})
    store = t.spark.read.parquet(path)
    ranged = readers.scan_store(store, "2024-01-05 09:00:00", "2024-01-12 15:00:00", [3, 4, 5, 6, 7], security="user_id")
    single = store.where(F.col("event_id").isin(17, 517, 917))
    return ranged.select("event_id", "user_id").union(single.select("event_id", "user_id")).distinct()


@query("store_cells", "row:s qualifier:s value:s", """
select cast(c_custkey as varchar) as "row", 'c_name' as qualifier, c_name as value from {customer}
union all select cast(c_custkey as varchar), 'c_nationkey', cast(c_nationkey as varchar) from {customer}
union all select cast(c_custkey as varchar), 'segment', c_mktsegment from {customer} where c_mktsegment <> 'BUILDING'""")
def store_cells(t):
    wide = t["customer"].select(
        F.col("c_custkey").alias("key"), "c_name", "c_nationkey",
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
    )
    return readers.scan_cells(wide, "key")


# --- rules -----------------------------------------------------------------

_RULE = "trade_date:s rule:s n:i"
_SESSION = "(clock between 93000000 and 113000000 or clock between 130000000 and 145700000)"
_PRICE_BAD = (" or ".join(f"{c} < 0 or {c} > 99999999" for c in rules.SNAP_PRICES))
_SNAP_BAD = f"({_PRICE_BAD} or highpx < lastpx or lowpx > lastpx)"
_NEGATIVE = "(numtrades < 0 or totalvolumetrade < 0 or totalvaluetrade < 0)"
_HIGH_LOW = "(lastpx > highpx or lastpx < lowpx or highpx < lowpx)"
_EMPTY_LEVEL = "(" + " or ".join(
    f"({s}px{i} <> 0 and {s}size{i} = 0)" for s in ("bid", "offer") for i in range(1, 11)) + ")"
_UNPRICED = "(" + " or ".join(
    f"({s}px{i} = 0 and {s}size{i} > 0)" for s in ("bid", "offer") for i in range(1, 11)) + ")"
# the book test as list steps over one 20-element list, worst bid first (1-based here)
_BOOK_LIST = "[" + ", ".join([f"bidpx{i}" for i in range(10, 0, -1)] + [f"offerpx{i}" for i in range(1, 11)]) + "]"
_BOOK_BAD = """(list_bool_or(list_transform(range(1, 10), lambda i:
    case when a[i] = 0 then i > 1 and a[greatest(i - 1, 1)] > 0 else a[i + 1] <= a[i] end))
  or (a[10] <> 0 and a[11] <> 0 and a[10] > a[11])
  or list_bool_or(list_transform(range(11, 20), lambda i:
    case when a[i] = 0 then a[i + 1] > 0 else a[i + 1] <> 0 and a[i + 1] <= a[i] end)))"""


def _count_sql(source: str, tests: dict[str, str], by: str = "trade_date") -> str:
    return " union all ".join(
        f"select {by}, '{name}' as rule, count(*) filter (where {bad}) as n from {source} group by {by}"
        for name, bad in tests.items()
    )


def _book_source(suffix: str = "") -> str:
    return f"(select *, {_BOOK_LIST} as a from {{sql_snap_level{suffix}}}) as b"


_ROW_SQL_NEW = " union all ".join([
    _count_sql("{sql_snap}", {
        "snap_price_range": _SNAP_BAD, "snap_negative_totals": _NEGATIVE, "snap_outside_high_low": _HIGH_LOW,
        "snap_outside_limits": "lastpx <> 0 and (lastpx > uplimitpx or lastpx < downlimitpx)"}),
    _count_sql(_book_source(), {
        "level_price_without_qty": f"{_SESSION} and {_EMPTY_LEVEL}", "level_qty_without_price": _UNPRICED,
        "level_order": f"{_SESSION} and {_BOOK_BAD}"}),
    _count_sql("{sql_order}", {"order_range": "(price < 0 or price > 99999999 or orderqty < 0) and price <> -1"}),
    _count_sql("{sql_trade}", {"trade_range": "exectype = 'F' and (price <= 0 or tradeqty <= 0)"}),
    _count_sql("(select * replace (cast(lowpx as double) as lowpx) from {sql_index}) as i", {
        "index_price_range": f"({_PRICE_BAD})",
        "index_negative_totals": "(totalvaluetrade < 0 or totalvolumetrade < 0)"}),
])


@query("rule_rows_new", _RULE, _ROW_SQL_NEW)
def rule_rows_new(t):
    parts = [rules.count_rows(feed(t, f), rules.row_rules(f)) for f in ("snap", "snap_level", "order", "trade", "index")]
    return reduce(DataFrame.unionByName, parts)


_ROW_SQL_OLD = " union all ".join([
    _count_sql("{sql_snap_old}", {
        "snap_price_range": f"{_SESSION} and ({_SNAP_BAD} or {_NEGATIVE})", "snap_negative_totals": _NEGATIVE,
        "snap_outside_high_low": _HIGH_LOW}),
    _count_sql(_book_source("_old"), {
        "level_price_without_qty": _EMPTY_LEVEL, "level_qty_without_price": _UNPRICED,
        "level_order": f"{_SESSION} and {_BOOK_BAD}"}),
    _count_sql("{sql_order_old}", {"order_range": "(price < 0 or price > 99999999 or orderqty < 0) and price <> -1"}),
    _count_sql("{sql_trade_old}", {"trade_range": "trim(functioncode) = '0' and (price <= 0 or tradeqty <= 0)"}),
    _count_sql("(select closeindex as preclosepx, lastindex as lastpx, openindex as openpx, highindex as highpx, "
               "lowindex as lowpx, * from {sql_index_old}) as i", {
                   "index_price_range": f"({_PRICE_BAD})",
                   "index_negative_totals": "(numtrades < 0 or totalvolumetraded < 0)"}),
])


@query("rule_rows_old", _RULE, _ROW_SQL_OLD)
def rule_rows_old(t):
    parts = [rules.count_rows(feed(t, f, "old"), rules.row_rules(f, "old"))
             for f in ("snap", "snap_level", "order", "trade", "index")]
    return reduce(DataFrame.unionByName, parts)


@query("rule_book_detail", "trade_date:s securityid:s rule:s n:i",
       "select * from (" + _count_sql(_book_source(), {"level_order": _BOOK_BAD}, "trade_date, securityid")
       + ") as x where n > 0")
def rule_book_detail(t):
    return rules.count_rows(feed(t, "snap_level"), {"level_order": rules.book_out_of_order()}, detail=True)


def _lag_sql(source: str, rule: str, order: str, cols: list[str], bad: str, session: bool = False,
             keep: str = "", by: str = "trade_date") -> str:
    """Breaks per day by a plain lag; ties ordered by all watched columns."""
    ties = ", ".join(dict.fromkeys([*order.split(", "), *cols, *([keep] if keep else [])]))
    lags = ", ".join(f"lag({c}) over w as p_{c}" for c in cols)
    only = f" and {_SESSION}" if session else ""
    return (
        f"select {by}, '{rule}' as rule, count(*) filter (where ({bad}){only}) as n from "
        f"(select *, {lags} from {source} window w as (partition by trade_date, securityid order by {ties})) as l "
        f"group by {by}"
    )


_FALLS = " or ".join(f"{c} < p_{c}" for c in rules.COUNTERS)
_ALL_FALL = "ts <= p_ts and " + " and ".join(f"{c} < p_{c}" for c in rules.COUNTERS)
_WATCHED = [*rules.COUNTERS, "ts"]


@query("rule_counters_fall_any", _RULE,
       _lag_sql("{sql_snap}", "snap_counters_fall", "ts", _WATCHED, f"ts <= p_ts or {_FALLS}"))
def rule_counters_fall_any(t):
    return rules.count_breaks(feed(t, "snap"), "snap_counters_fall", ["ts"], falls=rules.COUNTERS, not_rising=["ts"])


@query("rule_counters_fall_all", _RULE,
       _lag_sql("{sql_ticks}", "ticks_fall", "applseqnum", ["value", "volume", "step"],
                "value < p_value and volume < p_volume and step <= p_step"))
def rule_counters_fall_all(t):
    return rules.count_breaks(t["sql_ticks"], "ticks_fall", ["applseqnum"], falls=["value", "volume"],
                              not_rising=["step"], mode="all")


@query("rule_counters_fall_old", _RULE,
       _lag_sql("{sql_snap_old}", "snap_counters_fall", "ts, numtrades", rules.COUNTERS, _FALLS, True, "clock"))
def rule_counters_fall_old(t):
    return rules.count_breaks(feed(t, "snap", "old"), "snap_counters_fall", ["ts", "numtrades"],
                              falls=rules.COUNTERS, sessions=times.CONTINUOUS_SESSIONS)


@query("rule_order_sequence_new", _RULE,
       _lag_sql("{sql_order}", "order_sequence", "applseqnum", ["ts", "applseqnum"],
                "applseqnum <= p_applseqnum or ts < p_ts"))
def rule_order_sequence_new(t):
    return rules.count_breaks(feed(t, "order"), "order_sequence", ["applseqnum"], falls=["ts"], not_rising=["applseqnum"])


@query("rule_order_sequence_old", _RULE,
       _lag_sql("(select *, recno as applseqnum from {sql_order_old}) as o", "order_sequence", "applseqnum",
                ["applseqnum", "clock"], "applseqnum < p_applseqnum or clock - p_clock < -1000"))
def rule_order_sequence_old(t):
    return rules.count_breaks(feed(t, "order", "old"), "order_sequence", ["applseqnum"],
                              falls={"applseqnum": 0, "clock": 1000})


@query("rule_trade_sequence", _RULE,
       _lag_sql("{sql_trade}", "trade_sequence", "applseqnum", ["ts", "applseqnum"],
                "applseqnum <= p_applseqnum or ts < p_ts"))
def rule_trade_sequence(t):
    return rules.count_breaks(feed(t, "trade"), "trade_sequence", ["applseqnum"], falls=["ts"], not_rising=["applseqnum"])


@query("rule_index_totals_fall", _RULE,
       _lag_sql("{sql_index}", "index_totals_fall", "ts", ["totalvaluetrade", "totalvolumetrade"],
                "totalvaluetrade < p_totalvaluetrade or totalvolumetrade < p_totalvolumetrade"))
def rule_index_totals_fall(t):
    return rules.count_breaks(feed(t, "index"), "index_totals_fall", ["ts"],
                              falls=["ts", "totalvaluetrade", "totalvolumetrade"])


@query("rule_high_low_moves_back", _RULE,
       _lag_sql("(select * replace (cast(lowpx as double) as lowpx) from {sql_index}) as i", "high_low_moves_back",
                "ts", ["highpx", "lowpx"],
                "(highpx <> 0 and highpx < p_highpx) or (lowpx <> 0 and lowpx > p_lowpx)"))
def rule_high_low_moves_back(t):
    return rules.count_breaks(feed(t, "index"), "high_low_moves_back", ["ts"], falls=["highpx"], rises=["lowpx"],
                              nonzero=True)


@query("rule_volume_summary", "trade_date:s feed:s n_securities:i n_rows:i", " union all ".join(
    f"select trade_date, '{f}' as feed, count(distinct securityid) as n_securities, count(*) as n_rows "
    f"from {{sql_{f}}} group by trade_date" for f in ("snap", "snap_level")))
def rule_volume_summary(t):
    return rules.volume_summary({"snap": feed(t, "snap"), "snap_level": feed(t, "snap_level")})


_RANGED = "trade_date between date '1995-01-01' and date '1995-12-31'"


@query("rule_volume_range", "feed:s n_rows:i n_securities:i near:i", " union all ".join(
    f"select '{f}' as feed, count(*) as n_rows, count(distinct securityid) as n_securities, 1 as near from {{sql_{f}}} where {_RANGED}"
    for f in ("order", "trade")))
def rule_volume_range(t):
    """A year from its days' states: rows, securities exactly and by sketches (near: within 2 %)."""
    feeds = {f: feed(t, f) for f in ("order", "trade")}
    bounds = ("1995-01-01", "1995-12-31")
    about = volumes.over_range(sinks.written(volumes.daily_states(feeds), "volumes"), *bounds)
    exact = volumes.exact_over_range(sinks.written(volumes.daily_bitmaps(feeds), "bitmaps"), *bounds)
    near = (F.abs(F.col("n_items") - F.col("n_securities")) <= F.col("n_securities") * 0.02).cast("int")
    return about.join(exact.withColumnRenamed("n_items", "n_securities"), "feed").withColumn("near", near)


@query("largest_trades", "place:i securityid:s applseqnum:i money:d", """
select row_number() over (order by money desc, securityid, applseqnum) as place, securityid, applseqnum, money
from (select securityid, applseqnum, cast(price as decimal(12,2)) * tradeqty as money from {sql_trade}) as t
qualify place <= 100""")
def largest_trades(t):
    """A report of the top hundred, in order: a limit as such."""
    money = (F.col("price").cast("decimal(12,2)") * F.col("tradeqty").cast("decimal(10,0)")).alias("money")
    top = relational.first_rows(feed(t, "trade").select("securityid", "applseqnum", money), [F.desc("money"), F.asc("securityid"), F.asc("applseqnum")], 100)
    w = Window.orderBy(F.desc("money"), "securityid", "applseqnum")  # a hundred rows
    return top.withColumn("place", F.row_number().over(w))


_SUMS_SQL = """
select t.trade_date, 'trade_sum_vs_total' as rule, count(*) filter (where {test}) as n from (
  select trade_date, securityid, sum(tradeqty) as qty,
    sum(cast(price as decimal(12,2)) * tradeqty) as money
  from {{sql_trade}} where exectype = 'F' group by 1, 2) t
join (select trade_date, securityid, max(totalvolumetrade) as tot_qty, max(totalvaluetrade) as tot_money
  from {{sql_totals}} group by 1, 2) s on t.trade_date = s.trade_date and t.securityid = s.securityid
group by t.trade_date"""
_QTY_OFF, _MONEY_OFF = "abs(qty - tot_qty) > 20", "abs(money - cast(tot_money as decimal(18,2))) > 20"


@query("rule_sum_vs_total_any", _RULE, _SUMS_SQL.format(test=f"{_QTY_OFF} or {_MONEY_OFF}"))
def rule_sum_vs_total_any(t):
    return rules.sum_vs_total(feed(t, "trade"), t["sql_totals"], tolerance=20)


@query("rule_sum_vs_total_all", _RULE, _SUMS_SQL.format(test=f"({_QTY_OFF}) and ({_MONEY_OFF})"))
def rule_sum_vs_total_all(t):
    return rules.sum_vs_total(feed(t, "trade"), t["sql_totals"], mode="all", tolerance=20)


_MISSING_SQL = """
select d.trade_date, 'trade_without_order' as rule, count(m.id) as n
from (select distinct trade_date from {sql_trade}) d left join (
  select distinct trade_date, id from (
    select trade_date, bidapplseqnum as id from {sql_trade} union all
    select trade_date, offerapplseqnum from {sql_trade}) as named
  where id <> 0 and not exists (select 1 from {sql_order} o where o.trade_date = named.trade_date and o.applseqnum = id)
) m on m.trade_date = d.trade_date group by d.trade_date"""


@query("rule_missing_reference", _RULE, _MISSING_SQL)
def rule_missing_reference(t):
    return rules.missing_reference(feed(t, "trade"), feed(t, "order"))


@query("rule_missing_reference_bitmap", _RULE, _MISSING_SQL)
def rule_missing_reference_bitmap(t):
    return rules.missing_reference_bitmap(feed(t, "trade"), feed(t, "order"))


@query("trades_outside_bitmaps", "securityid:s applseqnum:i number:i", """
select securityid, applseqnum, number from (
  select trade_date, securityid, applseqnum, bidapplseqnum as number from {sql_trade}
  union all select trade_date, securityid, applseqnum, offerapplseqnum from {sql_trade}) as named
where number <> 0 and not exists (select 1 from {sql_order} o where o.trade_date = named.trade_date and o.applseqnum = number)""")
def trades_outside_bitmaps(t):
    """Trades whose orders are lacking, looked up in bitmaps that two loads of orders left."""
    orders = feed(t, "order")
    loads = [bitmaps.number_bitmaps(orders.where(f"orderqty % 2 = {i}"), "applseqnum", ["trade_date"]) for i in (0, 1)]
    known = bitmaps.merged_bitmaps(loads[0].unionByName(loads[1]), ["trade_date"])
    named = rules.named_numbers(feed(t, "trade"), seq="number", keep=("trade_date", "securityid", "applseqnum"))
    return bitmaps.rows_outside(named, "number", known, ["trade_date"])


@query("rule_blank_cells", _RULE, " union all ".join(
    f"select trade_date, 'blank:{c}' as rule, count(*) filter (where {c} is null or trim({c}) = '' or {c} = 'NaN') as n "
    "from {sql_blanks} group by trade_date" for c in ("contact", "desk", "total")))
def rule_blank_cells(t):
    return rules.blank_cells(t["sql_blanks"], ["contact", "desk", "total"])


@query("rule_non_trading_day", _RULE, """
select trade_date, 'non_trading_day' as rule, count(*) filter (where clock > 80000000 and clock <= 170000000) as n
from {sql_index} where isodow(trade_date) in (6, 7) group by trade_date""")
def rule_non_trading_day(t):
    ticks = feed(t, "index")
    closed = ticks.select("trade_date").distinct().where(~times.weekday(F.col("trade_date")))
    return rules.on_closed_days(ticks, closed)


_REPORT_SQL = " union all ".join([
    _ROW_SQL_NEW,
    _lag_sql("{sql_snap}", "snap_counters_fall", "ts", _WATCHED, f"ts <= p_ts or {_FALLS}"),
    _lag_sql("{sql_snap}", "snap_high_low_moves_back", "ts", ["highpx", "lowpx"],
             "(highpx <> 0 and highpx < p_highpx) or (lowpx <> 0 and lowpx > p_lowpx)"),
    _lag_sql("{sql_order}", "order_sequence", "applseqnum", ["ts", "applseqnum"], "applseqnum <= p_applseqnum or ts < p_ts"),
    _lag_sql("{sql_trade}", "trade_sequence", "applseqnum", ["ts", "applseqnum"], "applseqnum <= p_applseqnum or ts < p_ts"),
    _lag_sql("{sql_index}", "index_totals_fall", "ts", ["totalvaluetrade", "totalvolumetrade"],
             "totalvaluetrade < p_totalvaluetrade or totalvolumetrade < p_totalvolumetrade"),
    _SUMS_SQL.format(test="qty <> tot_qty or money <> cast(tot_money as decimal(18,2))").replace("sql_totals", "sql_snap"),
    """select d.trade_date, 'trade_without_order' as rule, count(m.id) as n
from (select distinct trade_date from {sql_trade}) d left join (
  select distinct trade_date, id from (
    select trade_date, bidapplseqnum as id from {sql_trade} union all
    select trade_date, offerapplseqnum from {sql_trade}) as named
  where id <> 0 and not exists (select 1 from {sql_order} o where o.trade_date = named.trade_date and o.applseqnum = id)
) m on m.trade_date = d.trade_date group by d.trade_date""",
])


@query("rule_report", _RULE, _REPORT_SQL)
def rule_report(t):
    return rules.report({f: feed(t, f) for f in ("snap", "snap_level", "order", "trade", "index")})


_HIGH_LOW_BACK = "(highpx <> 0 and highpx < p_highpx) or (lowpx <> 0 and lowpx > p_lowpx)"
_OLD_TRADES = """(select *, recno as applseqnum, cast(trim(buyorderrecno) as bigint) as bidapplseqnum,
  cast(trim(sellorderrecno) as bigint) as offerapplseqnum from {sql_trade_old}) as o"""
_OLD_ORDERS = "(select *, recno as applseqnum from {sql_order_old}) as o"
_REPORT_SQL_OLD = " union all ".join([
    _ROW_SQL_OLD,
    _lag_sql("{sql_snap_old}", "snap_counters_fall", "ts, numtrades", rules.COUNTERS, _FALLS, True, "clock"),
    _lag_sql("{sql_snap_old}", "snap_high_low_moves_back", "ts", ["highpx", "lowpx"], _HIGH_LOW_BACK),
    _lag_sql(_OLD_ORDERS, "order_sequence", "applseqnum", ["applseqnum", "clock"],
             "applseqnum < p_applseqnum or clock - p_clock < -1000"),
    _lag_sql(_OLD_TRADES, "trade_sequence", "applseqnum", ["ts", "applseqnum"], "applseqnum <= p_applseqnum or ts < p_ts"),
    _lag_sql("(select *, totalvolumetraded as totalvolumetrade from {sql_index_old}) as i", "index_totals_fall", "ts, totalvolumetrade",
             ["totalvolumetrade"], "totalvolumetrade < p_totalvolumetrade"),
    """select t.trade_date, 'trade_sum_vs_total' as rule, count(*) filter (where qty <> tot_qty or money <> cast(tot_money as decimal(18,2))) as n
from (select trade_date, securityid, sum(tradeqty) as qty, sum(cast(price as decimal(12,2)) * tradeqty) as money from {sql_trade_old}
  where trim(functioncode) = '0' group by 1, 2) t
join (select trade_date, securityid, max(totalvolumetrade) as tot_qty, max(totalvaluetrade) as tot_money from {sql_snap_old} group by 1, 2) s
  on t.trade_date = s.trade_date and t.securityid = s.securityid group by t.trade_date""",
    f"""select d.trade_date, 'trade_without_order' as rule, count(m.id) as n
from (select distinct trade_date from {{sql_trade_old}}) d left join (
  select distinct trade_date, unnest([bidapplseqnum, offerapplseqnum]) as id from {_OLD_TRADES}
  except select trade_date, recno from {{sql_order_old}}) m on m.trade_date = d.trade_date and m.id <> 0 group by d.trade_date""",
])


@query("rule_report_old", _RULE, _REPORT_SQL_OLD)
def rule_report_old(t):
    return rules.report({f: feed(t, f, "old") for f in ("snap", "snap_level", "order", "trade", "index")}, "old")


_SH_SNAP = "(select ts, trade_date, securityid, " + ", ".join(
    f"cast({c} as {'double' if c == 'totalvaluetrade' else 'bigint'}) as {c}" for c in dict.fromkeys(["numtrades", *rules.COUNTERS])
) + " from {sql_snap_sh}) as s"


@query("rule_counters_fall_sh", _RULE,
       _lag_sql(_SH_SNAP, "snap_counters_fall", "ts, numtrades", rules.COUNTERS, _FALLS))
def rule_counters_fall_sh(t):
    """As in the report of that format: at any time of day."""
    counted = rules.feed_report("snap", feed(t, "snap", "sh"), "sh")
    return counted.where("rule = 'snap_counters_fall'")


_SH_FIELDS = {f"bidsize{i}": f"bid{i}orderqty" for i in range(1, 11)} | {f"offerpx{i}": f"offer{i}price" for i in range(1, 11)} | {
    f"offersize{i}": f"offer{i}orderqty" for i in range(1, 11)}
_SH_BOOKS = "(select *, " + _BOOK_LIST + " as a from (select ts, trade_date, securityid, " + ", ".join(
    f"cast({_SH_FIELDS.get(c, c)} as {'double' if 'px' in c else 'bigint'}) as {c}" for side in ("bid", "offer") for i in range(1, 11) for c in (f"{side}px{i}", f"{side}size{i}")
) + " from {sql_snap_sh}) as l) as b"
_SH_PRICES = "(select ts, trade_date, securityid, " + ", ".join(
    f"cast({c} as {'bigint' if c in ('numtrades', 'totalvolumetrade') else 'double'}) as {c}" for c in [*rules.SNAP_PRICES, *rules.COUNTERS]
) + " from {sql_snap_sh}) as s"
_REPORT_SQL_SH = " union all ".join([
    _count_sql(_SH_PRICES, {"snap_price_range": f"{_SNAP_BAD} or {_NEGATIVE}", "snap_negative_totals": _NEGATIVE, "snap_outside_high_low": _HIGH_LOW}),
    _count_sql(_SH_BOOKS, {"level_price_without_qty": _EMPTY_LEVEL, "level_qty_without_price": _UNPRICED, "level_order": _BOOK_BAD}),
    _count_sql("{sql_trade_sh}", {"trade_range": "cast(price as double) <= 0 or cast(tradeqty as double) <= 0"}),
    _lag_sql(_SH_PRICES, "snap_counters_fall", "ts, numtrades", rules.COUNTERS, _FALLS),
    _lag_sql(_SH_PRICES, "snap_high_low_moves_back", "ts", ["highpx", "lowpx"], _HIGH_LOW_BACK),
    """select t.trade_date, 'trade_sum_vs_total' as rule, count(*) filter (where qty <> tot_qty or money <> cast(tot_money as decimal(18,2))) as n
from (select trade_date, securityid, sum(cast(tradeqty as bigint)) as qty, sum(cast(price as decimal(12,2)) * cast(tradeqty as bigint)) as money
  from {sql_trade_sh} group by 1, 2) t
join (select trade_date, securityid, max(cast(totalvolumetrade as bigint)) as tot_qty, max(cast(totalvaluetrade as double)) as tot_money
  from {sql_snap_sh} group by 1, 2) s on t.trade_date = s.trade_date and t.securityid = s.securityid group by t.trade_date""",
    *[f"select trade_date, 'rows:{f}' as rule, count(*) as n from {{{x}}} group by trade_date union all "
      f"select trade_date, 'securities:{f}', count(distinct securityid) from {{{x}}} group by trade_date"
      for f, x in (("snap", "sql_snap_sh"), ("snap_level", "sql_snap_sh"), ("trade", "sql_trade_sh"))],
])


@query("rule_report_sh", _RULE, _REPORT_SQL_SH)
def rule_report_sh(t):
    """The report of that format, with its volumes. Books and snapshots are one file there,
    which is made and parsed once for all its rules."""
    snap = sinks.written(feed(t, "snap", "sh").select(*rules.SNAP_READ), "snap-sh")
    return rules.report({"snap": snap, "snap_level": snap, "trade": feed(t, "trade", "sh")}, "sh", volumes=True)


_BY_SECURITY = "trade_date, securityid"
_DETAIL_SQL = "select * from (" + " union all ".join([
    _count_sql("{sql_order}", {"order_range": "(price < 0 or price > 99999999 or orderqty < 0) and price <> -1"}, _BY_SECURITY),
    _count_sql("{sql_trade}", {"trade_range": "exectype = 'F' and (price <= 0 or tradeqty <= 0)"}, _BY_SECURITY),
    _lag_sql("{sql_order}", "order_sequence", "applseqnum", ["ts", "applseqnum"], "applseqnum <= p_applseqnum or ts < p_ts", by=_BY_SECURITY),
    _lag_sql("{sql_trade}", "trade_sequence", "applseqnum", ["ts", "applseqnum"], "applseqnum <= p_applseqnum or ts < p_ts", by=_BY_SECURITY),
    """select trade_date, securityid, 'trade_without_order' as rule, count(distinct id) as n from (
  select trade_date, securityid, unnest([bidapplseqnum, offerapplseqnum]) as id from {sql_trade}) as named
where id <> 0 and (trade_date, id) not in (select trade_date, applseqnum from {sql_order}) group by 1, 2""",
    *[f"select {_BY_SECURITY}, 'rows:{f}' as rule, count(*) as n from {{sql_{f}}} group by {_BY_SECURITY}" for f in ("order", "trade")],
    _count_sql("{sql_order}", {f"blank:order:{c}": f"{c} is null or trim({c}) = '' or {c} = 'NaN'" for c in ("contactor", "ordertype")}, _BY_SECURITY),
    *[_count_sql("(select * from {sql_%s} where isodow(trade_date) in (6, 7)) as c" % f, {f"non_trading_day:{f}": "clock > 80000000 and clock <= 170000000"}, _BY_SECURITY)
      for f in ("order", "trade")],
]) + ") as x where n > 0"


@query("rule_report_detail", "trade_date:s securityid:s rule:s n:i", _DETAIL_SQL)
def rule_report_detail(t):
    """Who breaks what: orders and trades per security, with volumes, blank cells and closed days."""
    feeds = {f: feed(t, f) for f in ("order", "trade")}
    closed = feeds["trade"].select("trade_date").unionByName(feeds["order"].select("trade_date")).distinct().where(~times.weekday(F.col("trade_date")))
    return rules.report(feeds, detail=True, volumes=True, tracked={"order": ["contactor", "ordertype"]}, holidays=closed)


# --- cleaning --------------------------------------------------------------

_KEEP_SNAP = f"""
select * from {{sql_snap_old}} s where not ({_SNAP_BAD} or {_NEGATIVE}) and not exists (
  select 1 from (select *, {", ".join(f"lag({c}) over w as p_{c}" for c in rules.COUNTERS)} from {{sql_snap_old}}
    window w as (partition by trade_date, securityid order by ts, {", ".join(rules.COUNTERS)}, clock)) as l
  where ({_FALLS}) and {_SESSION.replace("clock", "l.clock")} and l.trade_date = s.trade_date
    and l.securityid = s.securityid and l.ts = s.ts)"""


@query("clean_snapshots", "securityid:s tradedate:s datatimestamp:i totalvolumetrade:i",
       f"select securityid, tradedate, datatimestamp, totalvolumetrade from ({_KEEP_SNAP}) as k")
def clean_snapshots(t):
    return clean.clean_snapshots(feed(t, "snap", "old"))


@query("clean_books", "securityid:s tradedate:s datatimestamp:i sendtime:i", f"""
select securityid, tradedate, datatimestamp, sendtime from {{sql_snap_level_old}} s
where not exists (select 1 from {{sql_snap_level_old}} l where {_EMPTY_LEVEL.replace("(bid", "(l.bid").replace("(offer", "(l.offer").replace("and bid", "and l.bid").replace("and offer", "and l.offer")}
  and l.securityid = s.securityid and l.ts = s.ts)""")
def clean_books(t):
    return clean.clean_book(feed(t, "snap_level", "old"))


@query("latest_snapshots", "securityid:s volume:i", """
select securityid, max(qty) as volume from {order_base} group by securityid""")
def latest_snapshots(t):
    # one time per security and day here, so that there is something to choose from
    snaps = feed(t, "snap", "old").withColumns({
        "ts": F.lit("2000-01-01 09:30:00").cast("timestamp_ntz"), "trade_date": F.lit("2000-01-01").cast("date"),
    })
    return clean.latest_snapshots(snaps).withColumnRenamed("totalvolumetrade", "volume")


@query("latest_books", "securityid:s sendtime:i", """
select o.securityid, max(o.seq) as sendtime from {order_base} o
where o.seq in (select l_orderkey from {lineitem}) group by o.securityid""")
def latest_books(t):
    books = feed(t, "snap_level", "old").withColumns({
        "ts": F.lit("2000-01-01 09:30:00").cast("timestamp_ntz"), "trade_date": F.lit("2000-01-01").cast("date"),
    })
    return clean.latest_books(books)


_BAD_TRADES = """
select trade_date, securityid, ts, recno from {sql_trade_old}
where trim(functioncode) = '0' and (price <= 0 or tradeqty <= 0)
union all
select trade_date, securityid, ts, recno from (
  select *, lag(recno) over w as p_recno, lag(ts) over w as p_ts from {sql_trade_old}
  window w as (partition by trade_date, securityid order by recno, ts)) as l
where ts < p_ts or recno <= p_recno"""


@query("clean_trades", "securityid:s tradedate:s tradetime:i applseqnum:i price:d tradeqty:i", """
select securityid, tradedate, tradetime, recno as applseqnum, price, tradeqty from {sql_trade_old} t
where not exists (select 1 from {bad_trades} b where b.trade_date = t.trade_date and b.securityid = t.securityid
  and b.ts = t.ts and b.recno = t.recno)""", {"bad_trades": _BAD_TRADES})
def clean_trades(t):
    return clean.clean_trades(feed(t, "trade", "old"))


@query("clean_orders", "securityid:s tradedate:s orderentrytime:i applseqnum:i", """
select securityid, tradedate, orderentrytime, recno as applseqnum from {sql_order_old} t
where price >= 0 and orderqty >= 0 and not exists (
  select 1 from (select *, lag(recno) over w as p_recno, lag(clock) over w as p_clock from {sql_order_old}
    window w as (partition by trade_date, securityid order by recno, clock)) as l
  where (recno < p_recno or clock - p_clock < -1000) and l.trade_date = t.trade_date
    and l.securityid = t.securityid and l.recno = t.recno and l.clock = t.clock)""")
def clean_orders(t):
    return clean.clean_orders(feed(t, "order", "old"))


@query("clean_index", "securityid:s tradedate:s datatimestamp:i totalvolumetrade:i", """
select securityid, tradedate, datatimestamp, totalvolumetraded as totalvolumetrade from {sql_index_old} t
where not exists (
  select 1 from (select *, lag(totalvolumetraded) over w as p_vol from {sql_index_old}
    window w as (partition by trade_date, securityid order by ts, totalvolumetraded)) as l
  where totalvolumetraded < p_vol and l.securityid = t.securityid and l.ts = t.ts)""")
def clean_index(t):
    return clean.clean_index(feed(t, "index", "old"))
