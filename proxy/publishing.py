"""Queries over the publish and backfill jobs, every feed and format."""

from __future__ import annotations

from pyspark.sql import functions as F

from proxy.core import query
from proxy.market import (
    _HIGH_LOW, _INDEX_PHASE_SQL, _PHASE_SQL, _UNPRICED, _count_sql, _sql_key, feed, raw_feed,
)
from quotewell.functions import codes, times
from quotewell.operators import clean
from quotewell.plans import examine, publish, recon

_COMMON = ("MDDate", "MDTime", "SecurityID", "FullSecurityID", "SecurityIDSource", "SecurityType",
           "SecuritySubType", "Symbol", "MDLevel", "MDChannel", "MDRecordType", "row_key")


def _text(*names: str) -> str:
    return " ".join(f"{n}:s" for n in names)


def _sql_common(record: str, exchange: str, seq: str | None) -> str:
    full = f"concat(f.securityid, '.{exchange}')"
    source, channel = ("102", "4") if exchange == "SZ" else ("101", "3")
    return f"""strftime(f.trade_date, '%Y%m%d') as MDDate, lpad(cast(f.clock as varchar), 9, '0') as MDTime,
  f.securityid as SecurityID, {full} as FullSecurityID, '{source}' as SecurityIDSource, p.sectype as SecurityType,
  nullif(p.secsubtype, '-') as SecuritySubType, nullif(p.symbol, '-') as Symbol, '1' as MDLevel,
  '{channel}' as MDChannel, '{record}' as MDRecordType, {_sql_key(full, 'f.ts', seq)} as row_key"""


_JOIN = "from {{{feed}}} f join {{products_{exchange}}} p on p.prdtid = f.securityid"
_TRADE_COLUMNS = _text(*_COMMON, "TradeBSFlag", "TradeType") + (
    " TradeIndex:i TradeBuyNo:i TradeSellNo:i TradePrice:d TradeQty:i TradeMoney:d")
_MONEY = "cast(price as decimal(12,2)) * tradeqty"


def _trade_sql(kind: str, feed_name: str = "sql_trade", seq: str = "applseqnum", bid: str = "bidapplseqnum",
               offer: str = "offerapplseqnum") -> str:
    return f"""select {_sql_common('2', 'SZ', seq)}, '0' as TradeBSFlag, {kind} as TradeType, {seq} as TradeIndex,
  {bid} as TradeBuyNo, {offer} as TradeSellNo, price as TradePrice, tradeqty as TradeQty, {_MONEY} as TradeMoney
{_JOIN.format(feed=feed_name, exchange='sz')}"""


_NEW_TRADE = _trade_sql("case exectype when '4' then '1' when 'F' then '0' end")


@query("publish_trades_new", _TRADE_COLUMNS,
       _NEW_TRADE + " where price >= 0 and clock between 93000000 and 145700000")
def publish_trades_new(t):
    trades = raw_feed(t, "trade").where("price >= 0")
    return publish.publish_trades(trades, t["products_sz"], window=("093000000", "145700000"))


_CLEAN_TRADE = """
select * from {sql_trade_old} t where not exists (
  select 1 from (
    select trade_date, securityid, ts, recno from {sql_trade_old}
    where trim(functioncode) = '0' and (price <= 0 or tradeqty <= 0)
    union all
    select trade_date, securityid, ts, recno from (
      select *, lag(recno) over w as p_recno, lag(ts) over w as p_ts from {sql_trade_old}
      window w as (partition by trade_date, securityid order by recno, ts)) as l
    where ts < p_ts or recno <= p_recno) as b
  where b.trade_date = t.trade_date and b.securityid = t.securityid and b.ts = t.ts and b.recno = t.recno)"""


@query("publish_trades_old", _TRADE_COLUMNS, _trade_sql(
    "case concat(trim(functioncode), trim(orderkind)) when '00' then '0' when 'C0' then '1' when 'C2' then '2' end",
    "clean_trade", "recno", "cast(trim(buyorderrecno) as bigint)", "cast(trim(sellorderrecno) as bigint)",
), {"clean_trade": _CLEAN_TRADE})
def publish_trades_old(t):
    return publish.publish_trades(clean.clean_trades(feed(t, "trade", "old")), t["products_sz"], "old")


_NUMBERED = """
select *, row_number() over (partition by trade_date, securityid order by ts, tradetime, cast(price as double),
    cast(tradeqty as bigint), cast(tradeamount as double), cast(bidapplseqnum as bigint),
    cast(offerapplseqnum as bigint)) as seq from {sql_trade_sh}"""


@query("publish_trades_sh", _TRADE_COLUMNS, f"""
select {_sql_common('2', 'SH', 'seq')},
  case when cast(bidapplseqnum as bigint) > cast(offerapplseqnum as bigint) then '1'
       when cast(bidapplseqnum as bigint) < cast(offerapplseqnum as bigint) then '2' end as TradeBSFlag,
  '0' as TradeType, seq as TradeIndex, cast(bidapplseqnum as bigint) as TradeBuyNo,
  cast(offerapplseqnum as bigint) as TradeSellNo, cast(price as double) as TradePrice,
  cast(tradeqty as bigint) as TradeQty, cast(tradeamount as double) as TradeMoney
{_JOIN.format(feed='numbered', exchange='sh')}""", {"numbered": _NUMBERED})
def publish_trades_sh(t):
    return publish.publish_trades(feed(t, "trade", "sh"), t["products_sh"], "sh")


_ORDER_COLUMNS = _text(*_COMMON, "OrderType", "OrderBSFlag") + " OrderIndex:i OrderPrice:d OrderQty:i"


_NEW_ORDER_COLUMNS = _ORDER_COLUMNS + " " + _text(
    "ExpirationType", "ExpirationDays", "Contactor", "ContactInfo", "ConfirmID", "MDStreamID")
_NEW_ORDER = f"""
select {_sql_common('4', 'SZ', 'applseqnum')}, case when ordertype = 'U' then '3' else ordertype end as OrderType,
  case side when '1' then '1' when 'G' then '1' when '2' then '2' when 'F' then '2' end as OrderBSFlag,
  applseqnum as OrderIndex, price as OrderPrice, orderqty as OrderQty,
  cast(expirationtype as varchar) as ExpirationType, cast(expirationdays as varchar) as ExpirationDays,
  nullif(contactor, 'NULL') as Contactor, nullif(contactinfo, 'NULL') as ContactInfo, confirmid as ConfirmID,
  mdstreamid as MDStreamID {_JOIN.format(feed='sql_order', exchange='sz')}"""


@query("publish_orders_new", _NEW_ORDER_COLUMNS, _NEW_ORDER + " where price >= 0")
def publish_orders_new(t):
    return publish.publish_orders(raw_feed(t, "order").where("price >= 0"), t["products_sz"])


_CLEAN_ORDER = """
select * from {sql_order_old} t where price >= 0 and orderqty >= 0 and not exists (
  select 1 from (select *, lag(recno) over w as p_recno, lag(clock) over w as p_clock from {sql_order_old}
    window w as (partition by trade_date, securityid order by recno, clock)) as l
  where (recno < p_recno or clock - p_clock < -1000) and l.trade_date = t.trade_date
    and l.securityid = t.securityid and l.recno = t.recno and l.clock = t.clock)"""


@query("publish_orders_old", _ORDER_COLUMNS, f"""
select {_sql_common('4', 'SZ', 'recno')},
  case trim(orderkind) when '0' then '2' when 'X' then '3' when 'Y' then '4' when '2' then '5' when 'V' then '6'
                       when 'W' then '7' end as OrderType,
  case trim(functioncode) when 'B' then '1' when 'C' then '5' when 'S' then '2' end as OrderBSFlag,
  recno as OrderIndex, price as OrderPrice, orderqty as OrderQty {_JOIN.format(feed='clean_order', exchange='sz')}""",
       {"clean_order": _CLEAN_ORDER})
def publish_orders_old(t):
    return publish.publish_orders(clean.clean_orders(feed(t, "order", "old")), t["products_sz"], "old")


_INDEX_NUMBERS = "PreClosePx:d TotalVolumeTrade:i TotalValueTrade:d LastPx:d OpenPx:d HighPx:d LowPx:d"


_NEW_INDEX_COLUMNS = _text(*_COMMON, "TradingPhaseCode", "MDStreamID") + f" phase_rejected:i {_INDEX_NUMBERS}"
_NEW_INDEX = f"""
select {_sql_common('1', 'SZ', None)}, {_INDEX_PHASE_SQL.format(c='tradingphasecode')} as TradingPhaseCode,
  mdstreamid as MDStreamID, case when {_INDEX_PHASE_SQL.format(c='tradingphasecode')} is null then 1 else 0 end as phase_rejected,
  preclosepx as PreClosePx, totalvolumetrade as TotalVolumeTrade, totalvaluetrade as TotalValueTrade, lastpx as LastPx,
  openpx as OpenPx, highpx as HighPx, cast(lowpx as double) as LowPx {_JOIN.format(feed='sql_index', exchange='sz')}"""


@query("publish_index_new", _NEW_INDEX_COLUMNS, _NEW_INDEX)
def publish_index_new(t):
    return publish.publish_index(raw_feed(t, "index"), t["products_sz"])


_CLEAN_INDEX = """
select * from {sql_index_old} t where not exists (
  select 1 from (select *, lag(totalvolumetraded) over w as p_vol from {sql_index_old}
    window w as (partition by trade_date, securityid order by ts, totalvolumetraded)) as l
  where totalvolumetraded < p_vol and l.securityid = t.securityid and l.ts = t.ts)"""


@query("publish_index_old", _text(*_COMMON) + f" {_INDEX_NUMBERS}", f"""
select {_sql_common('1', 'SZ', None)}, closeindex as PreClosePx, totalvolumetraded as TotalVolumeTrade,
  turnover as TotalValueTrade, lastindex as LastPx, openindex as OpenPx, highindex as HighPx, lowindex as LowPx
{_JOIN.format(feed='clean_index_rows', exchange='sz')}""", {"clean_index_rows": _CLEAN_INDEX})
def publish_index_old(t):
    return publish.publish_index(clean.clean_index(feed(t, "index", "old")), t["products_sz"], "old")


# --- snapshots -------------------------------------------------------------

_SIDES = (("bid", "Buy"), ("offer", "Sell"))
_BOOK_SPEC = " ".join(f"{b}{i}Price:d {b}{i}OrderQty:i" for _, b in _SIDES for i in range(1, 11))
_BOOK_SQL = ", ".join(
    f"{{b}}.{s}px{i} as {b}{i}Price, {{b}}.{s}size{i} as {b}{i}OrderQty" for s, b in _SIDES for i in range(1, 11))
_QUEUE_SPEC = "Buy1NumOrders:i Buy1NoOrders:i Sell1NumOrders:i Sell1NoOrders:i queued:d"
_QUEUE_SQL = """b.numorders_b1 as Buy1NumOrders, b.noorders_b1 as Buy1NoOrders, b.numorders_s1 as Sell1NumOrders,
  b.noorders_s1 as Sell1NoOrders,
  case when trim(b.orderqty_b1) <> '' then len(string_split(trim(b.orderqty_b1), '|')) end as queued"""
_SNAP_SPEC = ("PreClosePx:d NumTrades:i TotalVolumeTrade:i TotalValueTrade:d LastPx:d OpenPx:d HighPx:d LowPx:d "
              "WeightedAvgBidPx:d WeightedAvgOfferPx:d TotalBidQty:i TotalOfferQty:i")
_SNAP_SQL = """f.preclosepx as PreClosePx, f.numtrades as NumTrades, f.totalvolumetrade as TotalVolumeTrade,
  f.totalvaluetrade as TotalValueTrade, f.lastpx as LastPx, f.openpx as OpenPx, f.highpx as HighPx, f.lowpx as LowPx,
  f.weightedavgbidpx as WeightedAvgBidPx, f.weightedavgofferpx as WeightedAvgOfferPx"""
_BOOK_JOIN = "join {{{book}}} b on b.securityid = f.securityid and b.ts = f.ts"


def _queued(df):
    queue = F.col("Buy1OrderDetail")
    return df.withColumn("queued", F.when(queue.isNotNull(), F.size(queue)))


_NEW_SNAP_COLUMNS = (
    f"{_text(*_COMMON, 'TradingPhaseCode', 'IOPV')} PreIOPV:d DiffPx1:d MaxPx:d MinPx:d SLYOne:d {_SNAP_SPEC} "
    f"{_BOOK_SPEC} {_QUEUE_SPEC}")
_NEW_SNAP = f"""
select {_sql_common('1', 'SZ', None)},
  {_PHASE_SQL.format(c='f.tradingphasecode').replace('clock', 'f.clock')} as TradingPhaseCode,
  case when p.sectype = '3' then nullif(f.realtimenav, 'NULL') end as IOPV, case when p.sectype = '3' then f.prenav end as PreIOPV,
  f.pxchange1 as DiffPx1, f.uplimitpx as MaxPx, f.downlimitpx as MinPx, f.peratio1 as SLYOne, {_SNAP_SQL},
  cast(string_split(f.totalbidqty, '.')[1] as bigint) as TotalBidQty,
  cast(string_split(f.totalofferqty, '.')[1] as bigint) as TotalOfferQty, {_BOOK_SQL.format(b='b')}, {_QUEUE_SQL}
{_JOIN.format(feed='sql_snap', exchange='sz')} {_BOOK_JOIN.format(book='sql_snap_level')}"""


@query("publish_snapshots_new", _NEW_SNAP_COLUMNS, _NEW_SNAP)
def publish_snapshots_new(t):
    return _queued(publish.publish_snapshots(raw_feed(t, "snap"), t["products_sz"], raw_feed(t, "snap_level")))


_CLEAN_BOOK = """
select * from {sql_snap_level_old} where not (""" + " or ".join(
    f"({s}px{i} <> 0 and {s}size{i} = 0)" for s in ("bid", "offer") for i in range(1, 11)) + ")"


@query("publish_snapshots_old", f"{_text(*_COMMON)} SLYOne:d {_SNAP_SPEC} {_BOOK_SPEC} {_QUEUE_SPEC}", f"""
select {_sql_common('1', 'SZ', None)}, f.peratio1 as SLYOne, {_SNAP_SQL}, f.totalbidqty as TotalBidQty,
  f.totalofferqty as TotalOfferQty, {_BOOK_SQL.format(b='b')}, {_QUEUE_SQL}
{_JOIN.format(feed='sql_snap_old', exchange='sz')} {_BOOK_JOIN.format(book='clean_book_rows')}
where p.sectype = '2'""", {"clean_book_rows": _CLEAN_BOOK})
def publish_snapshots_old(t):
    snaps = clean.latest_snapshots(feed(t, "snap", "old"))
    books = clean.latest_books(clean.clean_book(feed(t, "snap_level", "old")))
    stock = codes.SECURITY_TYPES["stock"]
    return _queued(publish.publish_snapshots(snaps, t["products_sz"], books, "old", sectype=stock))


_SH_BOOK_SQL = ", ".join(
    f"cast({f'bidpx{i}' if s == 'bid' else f'offer{i}price'} as double) as {b}{i}Price, "
    f"cast({s}{i}orderqty as bigint) as {b}{i}OrderQty, cast({s}{i}numorders as bigint) as {b}{i}NumOrders"
    for s, b in _SIDES for i in range(1, 11))
_SH_BOOK_SPEC = " ".join(
    f"{b}{i}Price:d {b}{i}OrderQty:i {b}{i}NumOrders:i" for _, b in _SIDES for i in range(1, 11))
_SH_CODES = " ".join(f"when '{k}' then '{v}'" for k, v in codes.PHASE_SH.items())


def _sh_queue(side: str) -> str:
    return " + ".join(f"(case when try_cast({side}1orders{i} as double) <> 0 then 1 else 0 end)" for i in range(1, 51))


@query("publish_snapshots_sh",
       f"{_text(*_COMMON, 'TradingPhaseCode', 'IOPV')} {_SNAP_SPEC} WithdrawBuyNumber:d NumOfferOrders:d "
       f"{_SH_BOOK_SPEC} Buy1NoOrders:i Sell1NoOrders:i", f"""
select {_sql_common('1', 'SH', None)}, case trim(instrumentstatus) {_SH_CODES} end as TradingPhaseCode,
  case when p.sectype = '3' then iopv end as IOPV, {_SNAP_SQL}, totalbidqty as TotalBidQty, totalofferqty as TotalOfferQty,
  withdrawbuynumber as WithdrawBuyNumber, numofferorders as NumOfferOrders, {_SH_BOOK_SQL},
  {_sh_queue('bid')} as Buy1NoOrders, {_sh_queue('offer')} as Sell1NoOrders
{_JOIN.format(feed='sql_snap_sh', exchange='sh')}""")
def publish_snapshots_sh(t):
    return publish.publish_snapshots(feed(t, "snap", "sh"), t["products_sh"], fmt="sh")


# --- backfill --------------------------------------------------------------

@query("backfill_trades", _TRADE_COLUMNS, _NEW_TRADE + """ where not exists (
  select 1 from {store_trade} s where s.securityid = f.securityid and s.ts = f.ts and s.applseqnum = f.applseqnum)""")
def backfill_trades(t):
    files = feed(t, "trade")
    counts = recon.key_counts(files, t["store_trade"], recon.KEYS["trade"])
    # each missing key once: the rows themselves come from the files
    missing = recon.one_sided(counts, "file", copies=False)
    return recon.backfill("trade", files, missing, t["products_sz"])


_STORED_SNAPS = """
select f.trade_date, f.securityid, f.ts, f.clock, f.totalvolumetrade, f.totalvaluetrade, f.highpx, f.lowpx, f.lastpx,
  f.uplimitpx, f.downlimitpx, f.numtrades, b.* exclude (securityid, origtime, trade_date, ts, clock)
from {sql_snap} f join {products_sz} p on p.prdtid = f.securityid
join {sql_snap_level} b on b.securityid = f.securityid and b.ts = f.ts"""
_BACK = {"totalvolumetrade_falls": "totalvolumetrade <> 0 and totalvolumetrade < p_vol",
         "totalvaluetrade_falls": "totalvaluetrade <> 0 and totalvaluetrade < p_val",
         "highpx_falls": "highpx <> 0 and highpx < p_high", "lowpx_rises": "lowpx <> 0 and lowpx > p_low"}
_TRACKED_HERE = [c for c in examine.TRACKED if c not in (
    "ClosePx", *publish.SNAP_SH_COLUMNS.values()) and not (c.endswith(("NumOrders", "NoOrders")) and c not in (
        "Buy1NumOrders", "Buy1NoOrders", "Sell1NumOrders", "Sell1NoOrders"))]


_PUBLISHED_HERE = {c.split(":")[0] for c in _NEW_SNAP_COLUMNS.split()}


@query("examine_store", "trade_date:s rule:s n:i", " union all ".join([
    _count_sql("{stored_snaps}", {
        "level_qty_without_price": _UNPRICED, "outside_limits": "lastpx <> 0 and (lastpx > uplimitpx or lastpx < downlimitpx)",
        "outside_high_low": _HIGH_LOW, "non_trading_day": "clock > 80000000 and clock <= 170000000"},
    ).replace("'non_trading_day' as rule, count(*) filter (where clock > 80000000 and clock <= 170000000) as n from {stored_snaps}",
              "'non_trading_day' as rule, count(*) filter (where clock > 80000000 and clock <= 170000000) as n from {stored_snaps} "
              "where isodow(trade_date) > 5"),
    _count_sql("""(select *, lag(totalvolumetrade) over w as p_vol, lag(totalvaluetrade) over w as p_val,
      lag(highpx) over w as p_high, lag(lowpx) over w as p_low from {stored_snaps}
      window w as (partition by trade_date, securityid order by ts)) as l""", _BACK),
    *[f"""select cast(strptime(MDDate, '%Y%m%d') as date), 'blank:{c}',
      count(*) filter (where {c} is null or trim(cast({c} as varchar)) in ('', 'NaN', 'nan')) from {{published_snaps}} group by MDDate"""
      for c in _TRACKED_HERE if c in _PUBLISHED_HERE],
    # the published SQL leaves these out; the feed fills them in every row
    f"select d, c, 0 from (select distinct trade_date as d from {{stored_snaps}}), "
    f"(select unnest([{', '.join(repr('blank:' + c) for c in _TRACKED_HERE if c not in _PUBLISHED_HERE)}]) as c)",
]), {"stored_snaps": _STORED_SNAPS, "published_snaps": _NEW_SNAP})
def examine_store(t):
    store = publish.publish_snapshots(feed(t, "snap"), t["products_sz"], feed(t, "snap_level"))
    closed = t["typed_snap"].select("trade_date").distinct().where(~times.weekday(F.col("trade_date")))
    return examine.examine(store, closed)
