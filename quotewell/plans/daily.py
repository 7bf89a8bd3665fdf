"""The daily chains: reconcile, save differences, optionally backfill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.functions.times import FULL_SESSIONS
from quotewell.plans import recon
from quotewell.sources import sinks

# Feeds in the order the daily chains run them.
CHAIN = ("snap", "trade", "order", "index")
BOND_FUND_CHAIN = ("bond", "fund")


def run_day(feeds: Mapping[str, DataFrame], stores: Mapping[str, str], products: DataFrame,
            out: str, books: DataFrame | None = None, insert: bool = False,
            chain: Sequence[str] = CHAIN, sessions=FULL_SESSIONS, days: Sequence | None = None) -> list[str]:
    """Reconciles each feed of the chain against its stored table, writing the
    statistics row and both difference sets under ``out``; with ``insert`` the
    rows missing from the store are published into it. Only the ``days`` are
    read from the store, by default those the files hold. Feeds without rows
    are skipped. Returns the feeds that ran."""
    done = []
    for feed in chain:
        files = feeds.get(feed)
        if files is None:
            continue
        held = sinks.days_of(files)
        wanted = held if days is None else [d for d in held if d in days]
        if not wanted:
            continue
        files = sinks.on_days(files, wanted)
        if feed in recon.SNAPSHOT_TYPES:
            files = recon.of_type(files, products, feed)
        spark = files.sparkSession
        store = spark.read.parquet(stores[feed])
        seq = {"trade": "TradeIndex", "order": "OrderIndex"}.get(feed)
        names = {"SecurityID": "securityid", **({seq: "applseqnum"} if seq else {})}
        stored = store.withColumnsRenamed(names)
        # both differences and the totals come from one small table of keys
        counts_at = f"{out}/{feed}/key_counts"
        sinks.write_diff(recon.key_counts(files, stored, [recon.DAY, *recon.KEYS[feed]], sessions, days=wanted), counts_at)
        counts = spark.read.parquet(counts_at)
        stats = recon.summary(counts, [recon.DAY]).withColumn("feed", F.lit(feed))
        sinks.append_stats(stats, f"{out}/stats")
        missing = recon.one_sided(counts, "file")
        sinks.write_diff(missing, f"{out}/{feed}/file_only")
        sinks.write_diff(recon.one_sided(counts, "store"), f"{out}/{feed}/store_only")
        if insert:
            extra = {"books": books} if feed in recon.SNAPSHOT_TYPES else {}
            rows = recon.backfill(feed, files, missing, products, **extra)
            sinks.upsert(rows, stores[feed], [recon.DAY, "row_key"])
        done.append(feed)
    return done
