"""Benchmark decontamination: Wu-Manber search for windows of benchmark words in whole documents."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.llm.common import col, read, saved, small_batches

WINDOW = 10  # words of a window
BLOCK_BYTES = 32 << 20  # of windows that are searched for together: what one broadcast holds, about
OVERHEAD = 64  # bytes a window takes beside its words
CHUNK = 8192  # windows in one batch on their way out of a worker

# A byte that belongs to a word stands for itself (A-Z for a-z), all others for a blank. In UTF-8 every
# byte of a character beyond ASCII is 0x80 or more, so bytes tell words apart as characters do.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


class Search:
    """Wu-Manber over words for a set of windows, one table set per window length.

    shift: a block (the last two words looked at; one word for windows of one)
    -> how far the cursor may move on without passing the end of a window;
    blocks of no window let it pass all but one word of a whole window. buckets:
    a block that ends windows -> those windows, compared directly.
    """

    def __init__(self, windows: Iterable[tuple[bytes, int]]):
        same: dict[bytes, bytes] = {}
        self.tables: dict[int, tuple[int, dict, dict]] = {}
        for text, key in windows:
            words = tuple(same.setdefault(w, w) for w in text.split())
            m = len(words)
            size, shift, buckets = self.tables.setdefault(m, (min(2, m), {}, {}))
            for end in range(size, m + 1):
                block = words[end - size:end]
                shift[block] = min(shift.get(block, m), m - end)
            buckets.setdefault(words[m - size:], {})[words] = key

    def find(self, words: list[bytes], marks: bytearray, found: set[int]) -> None:
        """Marks every word inside an occurrence and adds the keys of the windows that occur."""
        for m, (size, shift, buckets) in self.tables.items():
            far, end, n = m - size + 1, m, len(words)
            while end <= n:
                block = tuple(words[end - size:end])
                step = shift.get(block, far)
                if not step:
                    key = buckets[block].get(tuple(words[end - m:end]))
                    if key is not None:
                        found.add(key)
                        marks[end - m:end] = b"\1" * m
                    step = 1
                end += step


def _spans(marks: bytearray) -> list[tuple[int, int]]:
    out, at = [], marks.find(1)
    while at >= 0:
        stop = marks.find(0, at)
        stop = len(marks) if stop < 0 else stop
        out.append((at, stop))
        at = marks.find(1, stop)
    return out


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """window (its words, joined by blanks), item: every run of `window` words of (item, text), the whole text where it is shorter."""
    small_batches(items.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch["item"], batch["text"].cast(pa.binary()), strict=True):
                words = words_of(text.as_py())
                starts = range(max(1, len(words) - window + 1) if words else 0)
                for first in range(0, len(starts), CHUNK):
                    part = [b" ".join(words[i:i + window]) for i in starts[first:first + CHUNK]]
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([item.as_py()] * len(part), pa.string())], ["window", "item"])

    return items.mapInArrow(cut, "window binary, item string")


def blocks_of(windows: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[Broadcast]:
    """The distinct windows (window, list) dealt by hash to blocks of about block_bytes, each sent to the executors.

    Windows are distinct, so no block is hot, and the driver holds one block at
    a time. Executors keep blocks on disk and load the one they search.
    """
    context = windows.sparkSession.sparkContext
    total = windows.agg(F.sum(F.octet_length("window") + OVERHEAD)).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    out = []
    for i in range(n if total else 0):
        table = windows.where(F.pmod(F.xxhash64("window"), F.lit(n)) == i).select("window", "list").toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        out.append(context.broadcast(uuid.uuid4().bytes + sink.getvalue().to_pybytes()))
    return out


_LOADED: dict[bytes, Search] = {}  # of a worker: the block it searched last


def _search(block: Broadcast) -> Search:
    name = block.value[:16]
    if name not in _LOADED:
        _LOADED.clear()
        table = pa.ipc.open_stream(block.value[16:]).read_all()
        _LOADED[name] = Search(zip(table["window"].to_pylist(), table["list"].to_pylist(), strict=True))
    return _LOADED[name]


def scan(texts: DataFrame, blocks: list[Broadcast]) -> DataFrame:
    """ident, n_words, n_hit, spans (of hit words: first, and the one after the last), lists (keys of the windows found) per row of (ident, text)."""
    small_batches(texts.sparkSession)
    span = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [words_of(t) for t in batch["text"].cast(pa.binary()).to_pylist()]
            marks, found = [bytearray(len(w)) for w in rows], [set() for _ in rows]
            for block in blocks:
                search = _search(block)
                for words, mark, keys in zip(rows, marks, found, strict=True):
                    search.find(words, mark, keys)
            spans = [[{"first": a, "stop": b} for a, b in _spans(m)] for m in marks]
            yield pa.RecordBatch.from_arrays([
                batch["ident"], pa.array([len(w) for w in rows], pa.int64()), pa.array([m.count(1) for m in marks], pa.int64()),
                pa.array(spans, span), pa.array([sorted(k) for k in found], pa.list_(pa.int64())),
            ], ["ident", "n_words", "n_hit", "spans", "lists"])

    kind = texts.schema["ident"].dataType.simpleString()
    return texts.mapInArrow(look, f"ident {kind}, n_words long, n_hit long, spans array<struct<first:long,stop:long>>, lists array<long>")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
    text: str = "text", ident: str = "doc_id", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Which words of each document stand inside a benchmark window, and which items those windows are of.

    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower
    case. A window is `window` consecutive words of an item; an item of fewer
    words is one window, an item without words none. Null texts have no words.
    Rows of docs that repeat give a row each; items that repeat, or several
    texts of one item id, count once by id; a null item id counts as ''. Empty
    tables give an empty result or rows without hits.

    Returns ident, n_words, n_hit, spans, n_items, items (ids as text, sorted).

    Distinct windows are searched for in blocks of bounded size, each text being
    read once. Windows that stand in the same items share one key, so a text
    reports few keys, not one for each window and item, and the texts with the
    same keys share one list of items.
    """
    items = benchmark.select(F.coalesce(col(item).cast("string"), F.lit("")).alias("item"), col(item_text).cast("string").alias("text"))
    pairs = saved(windows_of(items, window).distinct(), "windows")
    marks = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("item")).alias("m1"), F.bit_xor(F.xxhash64(F.lit("second"), "item")).alias("m2")]
    listed = saved(pairs.groupBy("window").agg(*marks).select("window", F.xxhash64("n", "m1", "m2").alias("list")), "window-lists")
    lists = listed.groupBy("list").agg(F.min("window").alias("window")).join(pairs, "window").select("list", "item")
    texts = docs.select(col(ident).alias("ident"), col(text).cast("string").alias("text"))
    hits = saved(scan(texts, blocks_of(listed, block_bytes)), "hits")
    some, none = hits.where(F.size("lists") > 0), hits.where(F.size("lists") == 0)
    named = (
        some.select("lists").distinct().select("lists", F.explode("lists").alias("list")).join(lists, "list")
        .groupBy("lists").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    out = ["ident", "n_words", "n_hit", "spans", F.size("items").cast("long").alias("n_items"), "items"]
    empty: Column = F.array().cast("array<string>").alias("items")
    return none.select("*", empty).select(*out).unionByName(some.join(named, "lists").select(*out))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        F.col("ident").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP13_SQL = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM documents
), items AS (
    SELECT coalesce(cast(item_id AS varchar), '') AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item, size, array_to_string(w[p:p + size - 1], ' ') AS words
    FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS p
          FROM (SELECT item, w, least(10, len(w)) AS size FROM items WHERE len(w) > 0))
), found AS (
    SELECT DISTINCT doc_id, p, size, item
    FROM (SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS words
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
                FROM texts, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size))
    JOIN windows USING (size, words)
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS place FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
