"""Readers: raw feeds to one spelling of columns, dimensions, legacy text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.functions import times
from quotewell.functions.keys import key_time
from quotewell.sources.schemas import DEPTH, FEEDS, PRODUCTS

# Marker of a header row inside the data, and the columns of the
# spot file that the typed load keeps (0-based) with those among them that are text.
HEADER_MARK = "HEAD:v1"
SPOT_POSITIONS = (*range(12), 13, 14, 17, 19)
SPOT_TEXT = (0, 1, 2, 3, 9, 10)

# Old and SH column names -> new-format names, per feed.
_RENAMES = {
    ("old", "order"): {"recno": "applseqnum", "functioncode": "side", "orderkind": "ordertype"},
    ("old", "trade"): {"recno": "applseqnum", "buyorderrecno": "bidapplseqnum",
                       "sellorderrecno": "offerapplseqnum", "functioncode": "exectype"},
    ("old", "index"): {"closeindex": "preclosepx", "openindex": "openpx", "highindex": "highpx",
                       "lowindex": "lowpx", "lastindex": "lastpx", "turnover": "totalvaluetrade",
                       "totalvolumetraded": "totalvolumetrade"},
}
_OLD_CLOCK = {"snap": "datatimestamp", "snap_level": "datatimestamp", "order": "orderentrytime",
              "trade": "tradetime", "index": "datatimestamp"}


def _sh_book_names() -> dict[str, str]:
    names = {}
    for i in range(1, DEPTH + 1):
        names[f"bid{i}orderqty"] = f"bidsize{i}"
        names[f"offer{i}price"] = f"offerpx{i}"
        names[f"offer{i}orderqty"] = f"offersize{i}"
    return names


def _numeric_sh(df: DataFrame) -> DataFrame:
    """SH columns arrive as text; ids, times, codes and queues stay text."""
    text = {"securityid", "datetime", "tradetime", "instrumentstatus", "iopv"}
    whole = {"numtrades", "totalvolumetrade", "tradeqty", "bidapplseqnum", "offerapplseqnum"}
    casts = {}
    for name in df.columns:
        if name in text or name.startswith(("bid1orders", "offer1orders")):
            continue
        # whole numbers may come with decimals: '1200.000'
        casts[name] = (
            F.col(name).try_cast("decimal(20,3)").cast("bigint")
            if name in whole or name.endswith(("orderqty", "numorders")) or name.startswith(("bidsize", "offersize"))
            else F.col(name).try_cast("double")
        )
    return df.withColumns(casts)


def typed_columns(df: DataFrame, feed: str, fmt: str = "new") -> DataFrame:
    """New-format column names and types for any format, times left alone."""
    if fmt == "new":
        return df.withColumn("lowpx", F.col("lowpx").try_cast("double")) if feed == "index" else df
    if fmt == "old":
        out = df.withColumnsRenamed(_RENAMES.get(("old", feed), {}))
        if feed == "trade":
            out = out.withColumns({
                c: F.trim(c).try_cast("bigint") for c in ("bidapplseqnum", "offerapplseqnum")
            })
        return out
    if fmt == "sh":
        kept = df.where(F.col("securityid") != HEADER_MARK)
        return _numeric_sh(kept).withColumnsRenamed(_sh_book_names())
    raise ValueError(f"unknown format {fmt!r}")


def normalize(df: DataFrame, feed: str, fmt: str = "new", cs_as_ms: bool = True) -> DataFrame:
    """A raw feed with new-format column names plus trade_date, ts
    (timestamp_ntz) and clock (HHmmssSSS number). Header-marker rows go."""
    out = typed_columns(df, feed, fmt)
    # clock and trade_date come from the text, not from ts: filters on them are
    # pushed to the scan and must stay cheap there
    if fmt == "old":
        raw, stamp = F.col(_OLD_CLOCK[feed]), F.col("tradedate")
        ts, clock = times.parse_day_clock(F.substring(stamp, 1, 8), raw), raw.cast("bigint")
    elif fmt == "sh" and feed == "trade":
        stamp = F.col("tradetime")
        ts, clock = times.parse_ts16(stamp, cs_as_ms), times.text_clock16(stamp, cs_as_ms)
    elif fmt == "sh":
        stamp = F.col("datetime")
        ts, clock = times.parse_ts14(stamp), times.text_clock(stamp)
    else:
        stamp = F.col("origtime")
        ts, clock = times.parse_ts17(stamp), times.text_clock(stamp)
    return out.withColumns({"ts": ts, "clock": clock, "trade_date": times.text_day(stamp)})


def read_day(spark: SparkSession, path: str, day: str | None = None, end: str | None = None) -> DataFrame:
    """A day (or range of days) of a table partitioned by trade_date; only the
    partitions asked for are listed and read."""
    df = spark.read.parquet(path)
    if day is None:
        return df
    lo, hi = times.as_date(day), times.as_date(end or day)
    return df.where(F.col("trade_date").between(lo, hi))


def read_raw(spark: SparkSession, path: str, feed: str, fmt: str = "new", sep: str = "\t") -> DataFrame:
    """Raw delimited files of a feed under its declared schema."""
    return spark.read.csv(path, schema=FEEDS[fmt][feed], sep=sep)


def read_tsv(spark: SparkSession, path: str, positions: Sequence[int] = SPOT_POSITIONS,
             text: Sequence[int] | None = SPOT_TEXT) -> DataFrame:
    """Tab-separated text by field position, as columns s1, s2, ... ``text``
    names the positions left as text, the rest become doubles (null when not a
    number); ``text=None`` leaves everything as text."""
    width = max(positions) + 1
    schema = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(width)])
    raw = spark.read.csv(path, schema=schema, sep="\t", quote="")
    picked = []
    for n, p in enumerate(positions, 1):
        c = F.col(f"f{p}")
        picked.append((c if text is None or p in text else c.try_cast("double")).alias(f"s{n}"))
    return raw.select(*picked)


def read_products(spark: SparkSession, path: str, exchange: str | None = "SZ") -> DataFrame:
    """Product dimension (id with suffix, type, subtype, symbol). With an
    exchange: only its products, suffix stripped; with None: all, as they are."""
    return products_of(spark.read.csv(path, schema=PRODUCTS), exchange)


def products_of(products: DataFrame, exchange: str | None) -> DataFrame:
    if exchange is None:
        return products
    return products.where(F.col("prdtid").endswith(f".{exchange}")).withColumn(
        "prdtid", F.substring_index("prdtid", ".", 1)
    )


def read_diff(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Keys of a feed from saved difference lines '[security,time]' or, for
    trades and orders, '[security,time,seq]': securityid without its suffix, ts,
    and applseqnum where the feed has one. Lines whose time or number cannot be
    read give nulls, which match no row."""
    cells = F.split(F.regexp_replace(F.trim("value"), r"^\[|\]$", ""), ",")
    cell = [F.trim(F.get(cells, F.lit(i))) for i in range(3)]
    keys = [F.substring_index(cell[0], ".", 1).alias("securityid"), times.parse_ts17(cell[1]).alias("ts")]
    if feed in ("trade", "order"):
        keys.append(cell[2].try_cast("bigint").alias("applseqnum"))
    return spark.read.text(path).where(F.trim("value") != "").select(*keys)


def read_kv(spark: SparkSession, path: str) -> DataFrame:
    """key=value lines; blank lines and # comments are skipped."""
    line = F.trim("value")
    lines = spark.read.text(path).where((line != "") & ~line.startswith("#") & F.contains(line, F.lit("=")))
    return lines.select(
        F.trim(F.substring_index("value", "=", 1)).alias("key"),
        F.trim(F.regexp_replace("value", r"^[^=]*=", "")).alias("value"),
    )


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    day = F.trim(F.substring_index("value", ",", 1))
    return spark.read.text(path).where(F.trim("value") != "").select(
        F.try_to_date(day, "yyyyMMdd").alias("trade_date")
    )


def security_ids(df: DataFrame) -> DataFrame:
    return df.select("securityid").distinct()


def scan_store(store: DataFrame, start, end, ids: DataFrame | Sequence | None = None,
               security: str = "securityid", ts: str = "ts") -> DataFrame:
    """Rows of the serving table in a time range (inclusive), optionally only
    for the listed securities. The range also prunes trade_date partitions. A
    list of ids reaches the scan, which in a clustered table
    (``sinks.write_clustered``) then skips all other row groups."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    out = store.where(F.col(ts).between(lo, hi))
    if "trade_date" in store.columns:
        out = out.where(F.col("trade_date").between(F.to_date(lo), F.to_date(hi)))
    if ids is None or isinstance(ids, DataFrame):
        return out if ids is None else out.join(ids.select(security), security, "left_semi")
    return out.where(F.col(security).isin(list(ids)))


def key_times(store: DataFrame, key: str, security: str, zone: str = "UTC") -> DataFrame:
    """Serving rows with the time their key encodes."""
    return store.withColumn("key_ts", key_time(F.col(key), F.col(security), zone))


def scan_cells(df: DataFrame, key: str, family: str = "Detail") -> DataFrame:
    """A wide table as (row, family, qualifier, value) cells; absent cells have
    no row."""
    names = [c for c in df.columns if c != key]
    tall = df.select(F.col(key).alias("row"), *[F.col(c).cast("string").alias(c) for c in names])
    return (
        tall.unpivot(["row"], names, "qualifier", "value")
        .where(F.col("value").isNotNull())
        .select("row", F.lit(family).alias("family"), "qualifier", "value")
    )


# --- which feed a file belongs to -----------------------------------------

def feed_of_file(name: Column, fmt: str = "new") -> Column:
    """Feed name from a file name, null when it is none of them. The old format
    spells names in any letter case and marks book files with DW."""
    base = F.regexp_extract(name, r"([^/]+)$", 1)
    if fmt == "new":
        return (
            F.when(base.contains("snap_spot"), "snap")
            .when(base.contains("snap_level"), "snap_level")
            .when(base.contains("index"), "index")
            .when(base.contains("stock_status"), "stock_status")
            .when(base.contains("order"), "order")
            .when(base.contains("trade"), "trade")
        )
    low = F.lower(base)
    book = low.contains("dw")
    return (
        F.when(low.contains("index"), "index")
        .when(low.rlike("stock_?status"), "stock_status")
        .when(low.contains("stockinfo"), "stock_info")
        .when(low.contains("order"), "order")
        .when(low.contains("trade"), "trade")
        .when(low.contains("snap_level") | low.contains("snapshotdw"), "snap_level")
        .when(low.rlike("snap_spot|snapshot") & ~book, "snap")
    )
