"""Reconciliation and backfill of every feed. The stored side of a feed is its
own file rows without every third clock, so what is missing is known."""

from __future__ import annotations

from pyspark.sql import functions as F

from proxy.core import query
from proxy.market import _RECON_SUMS, feed, raw_feed
from proxy.publishing import (
    _NEW_INDEX, _NEW_INDEX_COLUMNS, _NEW_ORDER, _NEW_ORDER_COLUMNS, _NEW_SNAP, _NEW_SNAP_COLUMNS, _NEW_TRADE,
    _TRADE_COLUMNS, _queued,
)
from quotewell.plans import recon
from quotewell.session import scratch_dir
from quotewell.sources import readers

_SPEC = "trade_date:s n_store:i n_file:i n_common:i n_file_only:i n_store_only:i status:s"
_SOURCE = {"trade": "trade", "order": "order", "index": "index", "snap": "snap", "bond": "snap", "fund": "snap"}
_PUBLISHED = {
    "trade": (_TRADE_COLUMNS, _NEW_TRADE), "order": (_NEW_ORDER_COLUMNS, _NEW_ORDER), "index": (_NEW_INDEX_COLUMNS, _NEW_INDEX),
    **{name: (_NEW_SNAP_COLUMNS, _NEW_SNAP) for name in recon.SNAPSHOT_TYPES},
}
_STORED, _MISSING = "clock % 3 <> 0", "f.clock % 3 = 0"


def _of_type(name: str) -> str:
    kind = recon.SNAPSHOT_TYPES.get(name)
    return "" if kind is None else f" where securityid in (select prdtid from {{products_sz}} where sectype = '{kind}')"


def _recon_sql(name: str) -> str:
    keys = ", ".join(["trade_date", *recon.KEYS[name]])
    files = f"select {keys}, clock from {{sql_{_SOURCE[name]}}}{_of_type(name)}"
    return f"""
select trade_date, {_RECON_SUMS} from (
  select {keys}, sum(f) as n_file, sum(1 - f) as n_store from (
    select {keys}, 1 as f from ({files}) as a union all
    select {keys}, 0 from {{sql_{_SOURCE[name]}}} where {_STORED} and securityid in (select securityid from ({files}) as c)) as sides
  group by {keys}) as counted group by trade_date"""


def _sides(t, name):
    # saved keys hold milliseconds, so index ticks are taken as parsed from their text
    rows = raw_feed(t, "index") if name == "index" else feed(t, _SOURCE[name])
    files = recon.of_type(rows, t["products_sz"], name) if name in recon.SNAPSHOT_TYPES else rows
    return files, rows.where(_STORED)


def _counts(t, name):
    files, store = _sides(t, name)
    return recon.key_counts(files, store, ["trade_date", *recon.KEYS[name]])


def _publish(t, name, missing):
    extra = {"books": feed(t, "snap_level")} if name in recon.SNAPSHOT_TYPES else {}
    out = recon.backfill(name, _sides(t, name)[0], missing, t["products_sz"], **extra)
    return _queued(out) if name in recon.SNAPSHOT_TYPES else out


def _saved(t, name):
    """The missing keys by way of difference lines in a text file."""
    path = scratch_dir(t.spark, f"diff-{name}")
    keys = recon.one_sided(_counts(t, name), "file", copies=False)
    stamp = F.date_format("ts", "yyyyMMddHHmmssSSS")
    cells = [F.concat("securityid", F.lit(".SZ")), stamp, *(F.col(k).cast("string") for k in recon.KEYS[name][2:])]
    keys.select(F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]")).alias("value")).write.text(path)
    return readers.read_diff(t.spark, path, name)


def _register(name: str) -> None:
    columns, published = _PUBLISHED[name]
    kind = recon.SNAPSHOT_TYPES.get(name)
    backfilled = f"{published} where {_MISSING}" + (f" and p.sectype = '{kind}'" if kind else "")
    if name != "trade":
        query(f"recon_{name}", _SPEC, _recon_sql(name))(lambda t: recon.summary(_counts(t, name), ["trade_date"]))
        query(f"backfill_{name}", columns, backfilled)(
            lambda t: _publish(t, name, recon.one_sided(_counts(t, name), "file", copies=False)))
    if name not in ("bond", "fund"):
        query(f"backfill_saved_{name}", columns, backfilled)(lambda t: _publish(t, name, _saved(t, name)))


for _name in _SOURCE:
    _register(_name)



# The stored side of the digest queries: file rows that lost one clock in 601, hold an exchanged number
# for one in 607, and some trades the files do not have; the files repeat a third kind of rows.
_LOST, _SWAPPED, _ADDED, _TWICE = "mod(applseqnum, 601) = 0", "mod(applseqnum, 607) = 0", "mod(applseqnum, 613) = 0", "mod(applseqnum, 617) = 0"
_DIGEST_SQL = f"""
select trade_date, {_RECON_SUMS} from (
  select trade_date, securityid, ts, applseqnum, sum(f) as n_file, sum(1 - f) as n_store from (
    select trade_date, securityid, ts, applseqnum, 1 as f from {{sql_trade}}
    union all select trade_date, securityid, ts, applseqnum, 1 from {{sql_trade}} where {_TWICE}
    union all select trade_date, securityid, ts, case when {_SWAPPED} then -applseqnum else applseqnum end, 0
      from {{sql_trade}} where not {_LOST}
    union all select trade_date, securityid, ts, -1 - applseqnum, 0 from {{sql_trade}} where {_ADDED}) as sides
  group by trade_date, securityid, ts, applseqnum) as counted group by trade_date"""


def _digest_sides(t):
    rows = feed(t, "trade")
    seq = F.col("applseqnum")
    files = rows.unionByName(rows.where(_TWICE))
    swapped = rows.where(f"not {_LOST}").withColumn("applseqnum", F.when(F.expr(_SWAPPED), -seq).otherwise(seq))
    return files, swapped.unionByName(rows.where(_ADDED).withColumn("applseqnum", -1 - seq))


@query("recon_digest", _SPEC, _DIGEST_SQL)
def recon_digest(t):
    return recon.digest_diff(*_digest_sides(t), ["trade_date", *recon.KEYS["trade"]]).summary(["trade_date"])


@query("recon_digest_keys", "securityid:s applseqnum:i side:s n:i", """
select securityid, applseqnum, case when n_store = 0 then 'file' else 'store' end as side, n_file + n_store as n from (
""" + _DIGEST_SQL[_DIGEST_SQL.index("  select trade_date, securityid"):_DIGEST_SQL.rindex(") as counted")] + """) as c
where n_file = 0 or n_store = 0""")
def recon_digest_keys(t):
    """The keys of one side only come out of the few blocks that differ."""
    counts = recon.digest_diff(*_digest_sides(t), ["trade_date", *recon.KEYS["trade"]]).counts
    one = counts.where("n_file = 0 or n_store = 0")
    return one.select("securityid", "applseqnum", F.when(F.col("n_store") == 0, "file").otherwise("store").alias("side"), (F.col("n_file") + F.col("n_store")).alias("n"))
