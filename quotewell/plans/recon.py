"""Reconciling the day's files with the serving table, and backfilling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions import codes
from quotewell.functions.times import clock_number, in_sessions
from quotewell.operators.copies import COPIES, unfold_copies
from quotewell.operators.relational import present_in
from quotewell.plans import publish
from quotewell.sources import sinks

DAY, SECURITY = "trade_date", "securityid"
# What identifies a row, per feed.
KEYS = {
    "trade": [SECURITY, "ts", "applseqnum"], "order": [SECURITY, "ts", "applseqnum"],
    "index": [SECURITY, "ts"], "snap": [SECURITY, "ts"], "bond": [SECURITY, "ts"], "fund": [SECURITY, "ts"],
}
# The security type each snapshot chain covers.
SNAPSHOT_TYPES = {name: codes.SECURITY_TYPES[kind] for name, kind in
                  (("snap", "stock"), ("bond", "bond"), ("fund", "fund"))}


def _clock(df: DataFrame) -> Column:
    """The stored clock where there is one, else the clock of ts."""
    return F.col("clock") if "clock" in df.columns else clock_number(F.col("ts"))


def _counted(files: DataFrame, store: DataFrame, keys: Sequence[str]) -> DataFrame:
    side = [
        x.select(*keys, F.lit(f).alias("_f"), F.lit(s).alias("_s"))
        for x, f, s in ((files, 1, 0), (store, 0, 1))
    ]
    return side[0].unionByName(side[1]).groupBy(*keys).agg(
        F.sum("_f").alias("n_file"), F.sum("_s").alias("n_store")
    )


def key_counts(files: DataFrame, store: DataFrame, keys: Sequence[str], sessions=None,
               scope: str = "file_securities", security: str = SECURITY, days: Sequence | None = None) -> DataFrame:
    """How often each key occurs on either side: (keys..., n_file, n_store).

    Both sides are stacked and counted in one aggregation, so keys shuffle once
    and repeated keys are combined before they do. Nulls compare equal.
    ``sessions`` limits both sides; ``scope='file_securities'`` ignores stored
    securities the files do not mention.

    Only the ``days`` are compared, by default those of the files: they are
    listed first (one value per calendar day) and reach the stored table as
    literals that prune its partitions. Tables without a day are compared whole.
    """
    if DAY in files.columns and DAY in store.columns:
        days = sinks.days_of(files) if days is None else days
        files, store = (sinks.on_days(x, days) for x in (files, store))
    if sessions is not None:
        files, store = (x.where(in_sessions(_clock(x), sessions)) for x in (files, store))
    if scope == "file_securities":
        store = store.join(files.select(security).distinct(), security, "left_semi")
    return _counted(files, store, keys)


# --- digests first ---------------------------------------------------------

BLOCK_MINUTES = 5
_HALF = 0xFFFFFFFF


def _digest(keys: Sequence[str]) -> dict[str, Column]:
    """128 bits of two hashes of a row's key, as four numbers that add up
    without overflow. A sum does not cancel repeated keys as an XOR would."""
    first, second = F.xxhash64(*keys), F.xxhash64(F.lit("second"), *keys)
    return {
        "_d1": first.bitwiseAND(F.lit(_HALF)), "_d2": F.shiftrightunsigned(first, 32),
        "_d3": second.bitwiseAND(F.lit(_HALF)), "_d4": F.shiftrightunsigned(second, 32),
    }


def block_columns(keys: Sequence[str], minutes: int = BLOCK_MINUTES, security: str = SECURITY) -> dict[str, Column]:
    """What a digest is kept for: the day (where the key has one), the security,
    and a stretch of the clock."""
    clock = clock_number(F.col("ts"))
    block = {DAY: F.col(DAY)} if DAY in keys else {}
    return block | {security: F.col(security), "_block": F.floor(clock / F.lit(100000 * minutes)).cast("int")}


def digests(df: DataFrame, keys: Sequence[str], minutes: int = BLOCK_MINUTES, security: str = SECURITY) -> DataFrame:
    """Rows and digest of each (day, security, time block). Sums combine before
    the shuffle: blocks cross the network, keys do not."""
    block = block_columns(keys, minutes, security)
    parts = _digest(keys)
    return df.select(*[c.alias(n) for n, c in block.items()], *[c.alias(n) for n, c in parts.items()]).groupBy(*block).agg(
        F.count("*").alias("n"), *[F.sum(p).alias(p) for p in parts]
    )


@dataclass(frozen=True)
class DigestDiff:
    """``blocks``: every compared block with n_file, n_store and ``same``;
    ``counts``: key counts (as ``key_counts``) of the blocks that differ."""

    blocks: DataFrame
    counts: DataFrame

    def summary(self, by: Sequence[str] = ()) -> DataFrame:
        """As ``summary``, from blocks that agree and keys of those that do not.
        Stored keys do not repeat, so in a block that agrees every row is a common key."""
        n = F.col("n_file")
        zero = F.lit(0).cast("bigint")
        agreed = self.blocks.where("same").groupBy(*by).agg(F.coalesce(F.sum(n), zero).alias("n"))
        parts = agreed.select(*by, F.col("n").alias("n_store"), F.col("n").alias("n_file"), F.col("n").alias("n_common"), zero.alias("n_file_only"), zero.alias("n_store_only"))
        both = parts.unionByName(summary(self.counts, by).drop("status"))
        names = ["n_store", "n_file", "n_common", "n_file_only", "n_store_only"]
        out = both.groupBy(*by).agg(*[F.sum(c).alias(c) for c in names])
        return out.withColumn("status", F.when(F.col("n_common") > 0, "OK").otherwise("CHECK"))


def digest_diff(files: DataFrame, store: DataFrame, keys: Sequence[str], sessions=None, scope: str = "file_securities",
                security: str = SECURITY, days: Sequence | None = None, minutes: int = BLOCK_MINUTES) -> DigestDiff:
    """Reconciles by digest first: both sides are summed up per (day, security,
    time block), and only the keys of blocks whose sums differ are shuffled and
    compared, so a day that matches moves no keys at all.

    Days, sessions and scope as in ``key_counts``; the days of the files come
    from their digests, not from a pass of their own. The store holds a key
    once, as ``sinks.upsert`` leaves it; files may repeat keys, which makes
    their blocks differ. Two different blocks agree by chance once in 2^64."""
    if sessions is not None:
        files = files.where(in_sessions(_clock(files), sessions))
    held = sinks.written(digests(files, keys, minutes, security), "digests")
    if DAY in keys and DAY in store.columns:
        days = sinks.days_of(held) if days is None else days
        files, held, store = (sinks.on_days(x, days) for x in (files, held, store))
    if sessions is not None:
        store = store.where(in_sessions(_clock(store), sessions))
    stored = digests(store, keys, minutes, security)
    if scope == "file_securities":
        stored = stored.where(F.col(security).isNotNull())
    names = list(block_columns(keys, minutes, security))
    sums = ["_d1", "_d2", "_d3", "_d4"]
    zero = F.lit(0).cast("bigint")
    sides = [
        held.select(*names, *sums, F.col("n").alias("n_file"), zero.alias("n_store")),
        stored.select(*names, *[(-F.col(c)).alias(c) for c in sums], zero.alias("n_file"), F.col("n").alias("n_store")),
    ]
    met = sides[0].unionByName(sides[1]).groupBy(*names).agg(*[F.sum(c).alias(c) for c in (*sums, "n_file", "n_store")])
    same = reduce(lambda a, c: a & (F.col(c) == 0), sums, F.col("n_file") == F.col("n_store"))
    blocks = sinks.written(met.select(*names, "n_file", "n_store", same.alias("same")), "blocks")
    if scope == "file_securities":
        # blocks of the files name a security of the files; only blocks of the store alone are looked up
        alone = present_in(blocks.where("n_file = 0"), held.select(security).distinct(), [security])
        blocks = blocks.where("n_file > 0").unionByName(sinks.written(alone, "store-blocks"))
    differ = blocks.where(~F.col("same")).select(*[F.col(c).alias(f"_b_{c}") for c in names])

    def in_doubt(df: DataFrame) -> DataFrame:
        own = {n: n if n in keys else f"_o_{n}" for n in names}
        rows = df.select(*keys, *[c.alias(own[n]) for n, c in block_columns(keys, minutes, security).items() if n not in keys])
        match = reduce(lambda a, n: a & F.col(own[n]).eqNullSafe(F.col(f"_b_{n}")), names, F.lit(True))
        return rows.join(differ, match, "left_semi").select(*keys)

    counts = _counted(in_doubt(files), in_doubt(store), keys)
    return DigestDiff(blocks, counts)


def summary(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """File and store row counts, distinct common keys, one-sided rows, and the
    status: OK once anything is common, else CHECK."""
    f, s = F.col("n_file"), F.col("n_store")
    out = counts.groupBy(*by).agg(
        F.coalesce(F.sum(s), F.lit(0)).alias("n_store"),
        F.coalesce(F.sum(f), F.lit(0)).alias("n_file"),
        F.count_if((f > 0) & (s > 0)).alias("n_common"),
        F.coalesce(F.sum(F.when(s == 0, f)), F.lit(0)).alias("n_file_only"),
        F.coalesce(F.sum(F.when(f == 0, s)), F.lit(0)).alias("n_store_only"),
    )
    return out.withColumn("status", F.when(F.col("n_common") > 0, "OK").otherwise("CHECK"))


def one_sided(counts: DataFrame, side: str = "file", copies: bool = True) -> DataFrame:
    """Keys found on one side only, as often as they occur there (or once, with
    their number in ``_copies``, when ``copies`` is False)."""
    here, there = ("n_file", "n_store") if side == "file" else ("n_store", "n_file")
    diff = counts.where(F.col(there) == 0).withColumnRenamed(here, COPIES).drop(there)
    return unfold_copies(diff) if copies else diff


def backfill_rows(files: DataFrame, missing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The full file rows behind missing keys."""
    return present_in(files, missing, keys)


def backfill(feed: str, files: DataFrame, missing: DataFrame, products: DataFrame,
             books: DataFrame | None = None, **options) -> DataFrame:
    """Missing rows in publishable form; keys may come from ``one_sided`` or
    from a saved difference (``readers.read_diff``)."""
    lacking = [k for k in KEYS[feed] if k not in missing.columns]
    if lacking:
        raise ValueError(f"{feed} keys without {lacking}")
    rows = backfill_rows(files, missing, KEYS[feed])
    if feed == "trade":
        return publish.publish_trades(rows, products, **options)
    if feed == "order":
        return publish.publish_orders(rows, products, **options)
    if feed == "index":
        return publish.publish_index(rows, products, **options)
    return publish.publish_snapshots(rows, products, books, sectype=SNAPSHOT_TYPES[feed], **options)


def of_type(files: DataFrame, products: DataFrame, feed: str) -> DataFrame:
    """The snapshot rows a chain covers: securities of its type."""
    wanted = products.where(F.col("sectype") == SNAPSHOT_TYPES[feed])
    return present_in(files, wanted.withColumnRenamed("prdtid", SECURITY), [SECURITY])


def backfill_saved(diffs: Mapping[str, DataFrame | None], feeds: Mapping[str, DataFrame],
                   products: DataFrame, books: DataFrame | None = None) -> dict[str, DataFrame]:
    """Backfill of each feed that has a saved difference; absent ones are skipped."""
    out = {}
    for feed, missing in diffs.items():
        if missing is not None:
            extra = {"books": books} if feed in SNAPSHOT_TYPES else {}
            out[feed] = backfill(feed, feeds[feed], missing, products, **extra)
    return out


def revised_flags(trades: DataFrame, zone: str = "UTC", exchange: str = "SZ") -> DataFrame:
    """(trade_date, row_key, TradeBSFlag) for priced trades whose order numbers
    differ; to be upserted over the pending flag. Ties are left alone."""
    full = F.concat(F.col(SECURITY), F.lit(codes.EXCHANGES[exchange]["suffix"]))
    done = trades.where((F.col("price") != 0) & (F.col("tradeqty") != 0))
    flags = done.select(
        DAY,
        publish.row_key(full, F.col("ts"), F.col("applseqnum"), zone).alias("row_key"),
        codes.bs_flag(F.col("bidapplseqnum"), F.col("offerapplseqnum")).alias("TradeBSFlag"),
    ).where(F.col("TradeBSFlag").isNotNull())
    return flags.groupBy(DAY, "row_key").agg(F.max("TradeBSFlag").alias("TradeBSFlag"))


def reconcile(feeds: Mapping[str, DataFrame], stores: Mapping[str, DataFrame], sessions=None,
              scope: str = "file_securities") -> DataFrame:
    """One summary row per feed and day."""
    rows = []
    for feed, files in feeds.items():
        keys = [DAY, *KEYS[feed]]
        counts = key_counts(files, stores[feed], keys, sessions, scope)
        rows.append(summary(counts, [DAY]).withColumn("feed", F.lit(feed)))
    return reduce(DataFrame.unionByName, rows)
