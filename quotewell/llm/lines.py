"""Line dedup: drop the lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.llm.common import key_pair, packed, read, saved, unpacked

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: str) -> Column:
    return F.split(F.translate(F.col(text), _UPPER, _LOWER), "\n", -1)


def _key(line: str) -> Column:
    return F.btrim(F.col(line), F.lit(_BLANKS)).alias("key")


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def _common(base: DataFrame, min_docs: int, long_enough: Column) -> DataFrame:
    """h1, h2 of the keys that at least min_docs documents hold, of rows (ident, body).

    Keys are counted by row, with map-side combine, wherever an id has one row
    only. Of ids with several rows, and there alone, a key counts once an id.
    """
    ids = base.select(F.xxhash64("ident").alias("id"), F.xxhash64(F.lit("second"), "ident").alias("id2"), "ident", "body")
    known = F.col("ident").isNotNull()
    repeated = saved(ids.where(known).groupBy("id", "id2").count().where("count > 1").select("id", "id2"), "repeated-ids")
    keys = F.array_distinct(F.transform(_lines("body"), lambda line: F.btrim(line, F.lit(_BLANKS))))

    def hashed(rows: DataFrame, *keep: str) -> DataFrame:
        return rows.select(*keep, F.explode(keys).alias("key")).where(long_enough).select(*keep, *_hashes(F.col("key")))

    if repeated.limit(1).count():
        single = hashed(ids.join(repeated, ["id", "id2"], "left_anti"))
        several = hashed(ids.where(known).join(repeated, ["id", "id2"], "left_semi"), "id", "id2").distinct().select("h1", "h2")
        counted = single.unionByName(several)
    else:
        counted = hashed(ids)
    return saved(counted.groupBy("h1", "h2").count().where(F.col("count") >= min_docs).select("h1", "h2"), "common-lines")


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Drops lines whose key is in at least `min_docs` documents of docs.

    A line ends at \\n. Its key is the line without blanks at its ends and with
    A-Z in lower case; keys under `min_chars` code points are never dropped. A
    document is an id: it counts once per key however often it holds the line
    and however many rows it has. Rows without an id are documents each. Null and empty texts are one empty line. An empty table gives
    an empty result.

    Returns doc (the whole row), n_lines, n_dropped, kept (the remaining lines,
    joined by \\n; the text itself if nothing was dropped).

    Lines are exploded as 128-bit hashes and counted with map-side combine. The
    keys over the limit are at most lines / min_docs; they are written out, so
    the join with all lines is planned by their real size: broadcast when small,
    else a sort-merge join whose hot keys are split. Only positions of dropped
    lines go back to their documents, which rebuild the text from them.
    """
    base = docs.select(packed(docs), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"), F.col(f"`{ident}`").alias("ident"))
    base = base.select("doc", "body", "ident", *key_pair(F.col("ident"), F.col("body")))
    long_enough = F.length("key") >= min_chars
    common = _common(base, min_docs, long_enough)
    lines = base.select("k1", "k2", F.posexplode(_lines("body")).alias("pos", "line")).select("k1", "k2", "pos", _key("line")).where(long_enough)
    hits = (
        lines.select("k1", "k2", "pos", *_hashes(F.col("key"))).join(common, ["h1", "h2"])
        .groupBy("k1", "k2").agg(F.collect_set("pos").alias("dropped"))
    )
    # A line at position i sorts as 2i + 1 and a mark "dropped" as 2i, so one sort
    # puts each mark right before its line: n log n however much is dropped.
    parts = F.concat(
        F.transform(F.split("body", "\n", -1), lambda line, i: F.struct((i * 2 + 1).alias("at"), line.alias("line"))),
        F.transform("dropped", lambda i: F.struct((i * 2).alias("at"), F.lit(None).cast("string").alias("line"))),
    )
    before = F.array(F.struct(F.lit(-5).alias("at"), F.lit(None).cast("string").alias("line")))
    rest = F.zip_with(
        F.sort_array(parts), F.concat(before, F.sort_array(parts)),
        lambda this, last: F.when((this["at"] % 2 == 1) & (last["at"] != this["at"] - 1), this["line"]),
    )
    joined = base.join(hits, ["k1", "k2"], "left")
    return joined.select(
        "doc",
        (F.length("body") - F.length(F.replace("body", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("body")).otherwise(F.array_join(rest, "\n")).alias("kept"),
    )


def line_dedup_stage(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """The columns of docs with the shared lines gone from text; every row stays, a null text becomes empty."""
    return unpacked(line_dedup(docs, min_docs), docs, text=F.col("kept"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


OP8_SQL = r"""
WITH lines AS (
    SELECT doc_id, pos, parts[pos] AS line,
           translate(trim(parts[pos], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS pos
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), common AS (
    SELECT line_key FROM lines WHERE length(line_key) >= 1 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.line_key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.line_key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN common c USING (line_key)
GROUP BY doc_id
"""
