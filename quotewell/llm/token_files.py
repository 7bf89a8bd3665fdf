"""Token counts of flat token files: find the separators, stitch documents across blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewell.llm.bpe import Vocabulary, default_tokenizer
from quotewell.llm.common import col, read, small_batches
from quotewell.session import scratch_dir
from quotewell.sources.files import matching_paths

END_OF_DOCUMENT = 50256
BLOCK_TOKENS = 1 << 19


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, text: str = "text", ident: str = "doc_id", separator: int = END_OF_DOCUMENT) -> None:
    """Writes folder/kind=tokens: flat files of 16-bit little-endian ids, each text followed by the separator,
    and folder/kind=ids: files of the same part numbers with the documents' ids in the same order.

    One task writes one file of each kind in one attempt, so both always agree.
    Spark's text writer puts the separator as its line end, on any file system.
    Strings of special tokens in a text are encoded as ordinary text. A null or
    empty text is a bare separator; a null id is an empty entry. A vocabulary
    with ids beyond 16 bits is refused.
    """
    vocabulary = Vocabulary(docs.sparkSession, path or default_tokenizer())
    small_batches(docs.sparkSession)
    line_end = int(separator).to_bytes(2, "little").decode("latin-1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary.encoder()
        if max(own.raw, default=0) >= 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        for batch in batches:
            ids = own.encode(batch.column("body").to_pylist(), special=False)
            packed = [x.astype("<u2").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("ident"), pa.array(packed, pa.binary())], names=["ident", "packed"])

    rows = docs.select(col(ident).cast("string").alias("ident"), col(text).alias("body")).mapInArrow(run, "ident string, packed binary")
    rows = rows.withColumn("seq", F.monotonically_increasing_id())
    kinds = F.explode(F.array(
        F.struct(F.lit("tokens").alias("kind"), F.col("packed").cast("string").alias("value")),
        F.struct(F.lit("ids").alias("kind"), F.coalesce("ident", F.lit("")).alias("value")),
    )).alias("part")
    rows = rows.select("seq", kinds).select("part.kind", "part.value", "seq").sortWithinPartitions("kind", "seq")
    rows.select("kind", "value").write.partitionBy("kind").option("encoding", "ISO-8859-1").option("lineSep", line_end).text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    if not matching_paths(spark, folder):  # an empty table leaves no folder
        return spark.createDataFrame([], "file string, length long, content binary")
    return spark.read.format("binaryFile").load(folder).select(F.regexp_extract("path", r"([^/]+?)(-[0-9a-f]{8}-[^/]*)?$", 1).alias("file"), "length", "content")


def token_counts(spark: SparkSession, folder: str, separator: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents of the flat 16-bit token files in a folder: file, ordinal (from 0 in the file), start, n_tokens, complete.

    start and n_tokens leave the separators out. What follows the last separator
    of a file is one more document with complete = false; an empty file has
    none. Equal files give equal rows.

    A file is cut into blocks, each searched at once with numpy. A window over
    the blocks of a file, which are few as a file has at most 2 GB, carries the
    number of separators so far and the place of the last one into the next
    block, so documents may span any number of blocks.
    """
    size = 2 * block_tokens

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data"), strict=True):
                tokens = np.frombuffer(data.as_buffer(), dtype="<u2")
                found.append(np.flatnonzero(tokens == separator) + block * block_tokens)
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), batch.column("total"), places], names=["file", "block", "total", "places"])

    blocks = _files(spark, folder).where(F.col("length") > 1).select(
        "file", "content", F.floor(F.col("length") / 2).alias("total"), F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size).cast("int"))).alias("block"),
    ).select("file", "block", "total", F.substring("content", F.col("block") * size + 1, F.lit(size)).alias("data"))
    small_batches(spark, 8)
    found = blocks.mapInArrow(scan, "file string, block int, total long, places array<long>")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = found.select(
        "*",
        F.coalesce(F.sum(F.size("places")).over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.max(F.element_at(F.when(F.size("places") > 0, F.col("places")), -1)).over(before), F.lit(-1).cast("long")).alias("last_before"),
        (F.lead("block").over(W.partitionBy("file").orderBy("block")).isNull()).alias("is_last"),
    )
    starts = F.concat(F.array("last_before"), "places")
    stops = F.when(F.col("is_last"), F.concat("places", F.array("total"))).otherwise(F.col("places"))
    spans = carried.select("file", "n_before", "total", starts.alias("starts"), F.posexplode(stops).alias("i", "stop"))
    spans = spans.select(
        "file", (F.col("n_before") + F.col("i")).alias("ordinal"), (F.col("starts")[F.col("i")] + 1).alias("start"),
        (F.col("stop") - F.col("starts")[F.col("i")] - 1).alias("n_tokens"), (F.col("stop") < F.col("total")).alias("complete"),
    )
    return spans.where(F.col("complete") | (F.col("n_tokens") > 0))


def file_entries(spark: SparkSession, folder: str, separator: int = END_OF_DOCUMENT) -> DataFrame:
    """The entries of the id files beside token files: file, ordinal, ident."""
    line_end = int(separator).to_bytes(2, "little").decode("latin-1")
    entries = F.split(F.decode("content", "ISO-8859-1"), line_end, -1)
    return _files(spark, folder).select("file", F.posexplode(entries).alias("ordinal", "ident"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    write_token_files(read(spark, sf_dir, "documents"), folder)
    counts = token_counts(spark, f"{folder}/kind=tokens")
    return counts.where("complete").join(file_entries(spark, f"{folder}/kind=ids"), ["file", "ordinal"]).select(
        F.when(F.col("ident") != "", F.col("ident")).cast("long").alias("doc_id"), "file", "ordinal", "start", "n_tokens"
    )
