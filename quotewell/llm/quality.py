"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.llm.common import col, key_pair, packed, read, saved, small_batches, unpacked

ORDER = 4  # characters of an n-gram
BITS = 21  # of a character: every code point has a sign of its own
MASK = (1 << BITS) - 1
CALIBRATE = 5  # one in so many trusted documents sets the thresholds, the others train
MIN_CALIBRATE = 20  # with fewer of them a language takes the thresholds of all languages
FENCE = 0.99  # quantile of a language's trusted documents that its fence is
SHORT = 100  # characters; see judged()
BATCH_CHARS = 1 << 22  # characters whose n-grams are looked up together, about
_CHARS = 1 << 19  # characters looked at together


@dataclass(frozen=True)
class Model:
    """Per order from 1 the tables (hi, lo, p) of n-grams seen and (hi, lo, backoff) of contexts seen; base: probability of a character before anything is known.

    hi and lo hold the first two and the last two characters of an n-gram, BITS each.
    """

    levels: list[tuple[DataFrame, DataFrame]]
    base: float


def _pressed(rows: DataFrame, text: str = "body") -> DataFrame:
    """rows with their texts compressed one by one: what is dealt over the network, or waits on disk for it, is about a third."""
    rest = [c for c in rows.columns if c != text]

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_up = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array([zip_up(t) if t else t for t in texts], pa.binary())], names=[*rest, text])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in rest)
    return rows.mapInArrow(press, f"{kinds + ', ' if kinds else ''}{text} binary")


def _texts(column: pa.ChunkedArray | pa.Array) -> Iterator[str | None]:
    """The texts again, one at a time."""
    unzip = zstandard.ZstdDecompressor().decompress
    return (unzip(t).decode("utf-8", "surrogatepass") if t else (None if t is None else "") for t in column.to_pylist())


def _codes(text: str) -> np.ndarray:
    """Code points with digits as 0."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where((codes >= 48) & (codes <= 57), np.uint32(48), codes)


def _pieces(text: str) -> Iterator[np.ndarray]:
    """Codes of a text in parts of bounded size, each with the ORDER - 1 codes before it; borders are 0."""
    for at in range(0, max(len(text), 1), _CHARS):
        codes = _codes(text[max(0, at - ORDER + 1) : at + _CHARS])
        yield np.concatenate((np.zeros(ORDER - 1, np.uint32), codes)) if at == 0 else codes


def _halves(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """hi and lo of the n-gram that ends at each code from the ORDER-th on."""
    c = codes.astype(np.int64)
    return (c[:-3] << BITS) | c[1:-2], (c[2:-1] << BITS) | c[3:]


class _Keys:
    """One 64-bit key for each n-gram of the characters at hand.

    Up to 65,536 different characters share its bits exactly; with more (no
    script has so many) hi and lo are hashed into them.
    """

    def __init__(self, chars: np.ndarray):
        self.chars, self.exact = chars, len(chars) <= 1 << 16
        if self.exact:
            self.number = np.zeros(0x110000, np.uint64)
            self.number[chars] = np.arange(len(chars), dtype=np.uint64)

    def of(self, codes: np.ndarray) -> np.ndarray:
        if not self.exact:
            return self.hashed(*_halves(codes))
        n = self.number[codes]
        return (n[:-3] << np.uint64(48)) | (n[1:-2] << np.uint64(32)) | (n[2:-1] << np.uint64(16)) | n[3:]

    @staticmethod
    def hashed(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        x = hi.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (lo.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        return x ^ (x >> np.uint64(29))

    def of_halves(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        if not self.exact:
            return self.hashed(hi, lo)
        parts = [self.number[x] for x in (hi >> BITS, hi & MASK, lo >> BITS, lo & MASK)]
        return (parts[0] << np.uint64(48)) | (parts[1] << np.uint64(32)) | (parts[2] << np.uint64(16)) | parts[3]


def _groups(pieces: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The pieces in lists of about _CHARS codes."""
    group, size = [], 0
    for codes in pieces:
        group.append(codes)
        size += len(codes)
        if size >= _CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _counted(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """hi, lo and number of the different n-grams of the texts, sorted and counted some at a time."""
    pieces = [codes for text in texts if text for codes in _pieces(text)]
    if not pieces:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    present = np.zeros(0x110000, bool)
    for codes in pieces:
        present[codes] = True
    keys = _Keys(np.flatnonzero(present))
    parts = []
    for group in _groups(pieces):
        every = np.concatenate([keys.of(codes) for codes in group])
        if keys.exact:
            parts.append(np.unique(every, return_counts=True))
        else:
            own, first, n = np.unique(every, return_index=True, return_counts=True)
            parts.append((own, n, *(np.concatenate(x)[first] for x in zip(*map(_halves, group), strict=True))))
    every, n, *halves = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(every, kind="stable")
    every = every[order]
    starts = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    n = np.add.reduceat(n[order], starts)
    if not keys.exact:
        return halves[0][order][starts], halves[1][order][starts], n
    c = [keys.chars[(every[starts] >> np.uint64(shift)) & np.uint64(0xFFFF)].astype(np.int64) for shift in (48, 32, 16, 0)]
    return (c[0] << BITS) | c[1], (c[2] << BITS) | c[3], n


def count_ngrams(texts: DataFrame) -> DataFrame:
    """hi, lo and n of all n-grams of the only column (compressed), each batch counted before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _counted(_texts(batch.column(0)))], names=["hi", "lo", "n"])

    return texts.mapInArrow(run, "hi long, lo long, n long").groupBy("hi", "lo").agg(F.sum("n").alias("n"))


def _context(hi: str = "hi", lo: str = "lo") -> tuple[Column, Column]:
    """An n-gram without its last character."""
    return F.shiftright(hi, BITS), F.shiftleft(F.col(hi).bitwiseAND(MASK), BITS).bitwiseOR(F.shiftright(lo, BITS))


def _tail(order: int, hi: str = "hi", lo: str = "lo") -> tuple[Column, Column]:
    """An n-gram of this order without its first character."""
    zero = F.lit(0).cast("long")
    return (F.col(hi).bitwiseAND(MASK) if order == 4 else zero), (F.col(lo) if order >= 3 else F.col(lo).bitwiseAND(MASK) if order == 2 else zero)


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more."""
    n = counts.agg(*[F.sum((F.col("n") == i).cast("long")) for i in range(1, 5)]).first()
    n1, n2, n3, n4 = (float(x or 0) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]


def _own_discount(d: list[float]) -> Column:
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


def train(texts: DataFrame) -> Model:
    """The model of all rows of the only column, compressed (null texts left out before).

    The highest order counts occurrences, the lower ones in how many different
    characters they are seen after. All of it are joins of count tables, sharded
    by context and by suffix, and stays in tables:
    p(gram) = (n - D(n)) / total(ctx) + backoff(ctx) * p(gram without its first character).
    """
    small_batches(texts.sparkSession)
    levels = [saved(count_ngrams(texts), "ngrams")]
    for order in range(ORDER, 1, -1):
        hi, lo = _tail(order)
        levels.insert(0, saved(levels[0].groupBy(hi.alias("hi"), lo.alias("lo")).agg(F.count("*").alias("n")), f"counts-{order - 1}"))
    base = 1.0 / (levels[0].count() + 1)  # characters seen, and one for all others
    out: list[tuple[DataFrame, DataFrame]] = []
    for order, level in enumerate(levels, 1):
        d = _discounts(level)
        (ch, cl), (th, tl) = _context(), _tail(order)
        level = level.select("hi", "lo", "n", ch.alias("ch"), cl.alias("cl"), th.alias("th"), tl.alias("tl"))
        contexts = level.groupBy("ch", "cl").agg(F.sum("n").alias("total"), F.sum(_own_discount(d)).alias("left"))
        contexts = saved(contexts.select("ch", "cl", "total", (F.col("left") / F.col("total")).alias("backoff")), f"contexts-{order}")
        seen = level.join(contexts, ["ch", "cl"])
        if out:
            seen = seen.join(out[-1][0].select(F.col("hi").alias("th"), F.col("lo").alias("tl"), F.col("p").alias("lower")), ["th", "tl"])
        else:
            seen = seen.withColumn("lower", F.lit(base))
        p = (F.col("n") - _own_discount(d)) / F.col("total") + F.col("backoff") * F.col("lower")
        out.append((saved(seen.select("hi", "lo", p.alias("p")), f"model-{order}"), contexts.select(F.col("ch").alias("hi"), F.col("cl").alias("lo"), "backoff")))
    return Model(out, base)


def log_probabilities(grams: DataFrame, model: Model) -> DataFrame:
    """hi, lo, log: natural logarithm of the probability of the last character of each n-gram (distinct hi, lo).

    An n-gram takes its own probability where it was seen, else that of its
    suffix times the back-off of its context, and so on down: one left join a
    table, n-grams and model sharded alike.
    """
    rows = grams.select("hi", "lo", F.col("hi").alias("h"), F.col("lo").alias("l"), F.lit(1.0).alias("weight"), F.lit(None).cast("double").alias("p"))
    for order in range(ORDER, 0, -1):
        seen, contexts = model.levels[order - 1]
        (ch, cl), (th, tl) = _context("h", "l"), _tail(order, "h", "l")
        seen = seen.select(F.col("hi").alias("h"), F.col("lo").alias("l"), F.col("p").alias("own"))
        contexts = contexts.select(F.col("hi").alias("ch"), F.col("lo").alias("cl"), "backoff")
        rows = rows.join(seen, ["h", "l"], "left").withColumns({"ch": ch, "cl": cl}).join(contexts, ["ch", "cl"], "left")
        rows = rows.select(
            "hi", "lo", th.alias("h"), tl.alias("l"), (F.col("weight") * F.coalesce("backoff", F.lit(1.0))).alias("weight"),
            F.coalesce("p", F.col("weight") * F.col("own")).alias("p"),
        )
    return rows.select("hi", "lo", F.ln(F.greatest(F.coalesce("p", F.col("weight") * F.lit(model.base)), F.lit(1e-12))).alias("log"))


def _single(rows: DataFrame) -> tuple[DataFrame, bool]:
    """One row for each id and text (k1, k2), and whether any went: copies of a row would crowd the batch their keys name."""
    counts = rows.groupBy("k1", "k2").count()
    again = saved(counts.where("count > 1").select("k1", "k2"), "repeated")
    if not again.limit(1).count():
        return rows, False
    one = rows.join(again, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("body").alias("body"))
    return rows.join(again, ["k1", "k2"], "left_anti").select("k1", "k2", "body").unionByName(one.select("k1", "k2", "body")), True


def perplexities(rows: DataFrame, model: Model) -> DataFrame:
    """rows (k1, k2, body and others) with chars and perplexity per character in place of the text; null perplexity for a null or empty text.

    Texts are dealt into batches of about BATCH_CHARS characters by their keys,
    once. A batch names its different n-grams; these are joined with the model,
    each once for all batches, and the logarithms come back to the batches that
    named them, where the sums of the documents are made. What a task holds is
    one batch and its n-grams, whatever the size of the model.
    """
    spark = rows.sparkSession
    small_batches(spark)
    single, fewer = _single(rows)
    texts = single.select("k1", "k2", "body") if fewer else rows.select("k1", "k2", "body")
    total = texts.agg(F.sum(F.length("body").cast("long"))).first()[0] or 0
    n = max(1, -(-int(total) // BATCH_CHARS))
    dealt = _pressed(texts.select("k1", "k2", "body")).withColumn("batch", F.pmod(F.xxhash64("k1", "k2"), F.lit(n))).repartition("batch")

    def name(table: pa.Table) -> pa.Table:
        hi, lo, _ = _counted(_texts(table.column("body")))
        return pa.table({"batch": pa.array(np.full(len(hi), table.column("batch")[0].as_py()), pa.int64()), "hi": pa.array(hi, pa.int64()), "lo": pa.array(lo, pa.int64())})

    named = dealt.groupBy("batch").applyInArrow(name, "batch long, hi long, lo long")
    logs = log_probabilities(named.select("hi", "lo").distinct(), model)
    known = named.join(logs, ["hi", "lo"]).select("batch", "hi", "lo", "log")

    def score(docs: pa.Table, grams: pa.Table) -> pa.Table:
        hi, lo, log = (grams.column(c).to_numpy() for c in ("hi", "lo", "log"))
        keys = _Keys(np.unique(np.concatenate([hi >> BITS, hi & MASK, lo >> BITS, lo & MASK])))
        own = keys.of_halves(hi, lo)
        order = np.argsort(own)
        own, log = own[order], log[order]
        out, chars = [], []
        for body in _texts(docs.column("body")):
            total, n = 0.0, 0
            for codes in _pieces(body) if body else ():
                at = np.searchsorted(own, keys.of(codes))
                total += float(log[at].sum())
                n += len(at)
            out.append(float(np.exp(-total / n)) if n else None)
            chars.append(n)
        return pa.table({"k1": docs.column("k1"), "k2": docs.column("k2"), "chars": pa.array(chars, pa.int64()), "perplexity": pa.array(out, pa.float64())})

    found = dealt.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(score, "k1 long, k2 long, chars long, perplexity double")
    others = [c for c in rows.columns if c != "body"]
    return rows.select(*others).join(saved(found, "scores"), ["k1", "k2"]).select(*others, "chars", "perplexity")


def _calibrating(ident: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("calibrate"), ident), F.lit(CALIBRATE)) == 0


def judged(docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id", lang: str = "lang") -> DataFrame:
    """k1, k2 (hash of id and text), ident, lang, perplexity, threshold, keep, one row per row of docs.

    Trusted text is that of documents labelled quality 1 and not toxic. One in
    CALIBRATE of them, by the hash of its id, is kept out of training; their
    perplexities give each language its fence, the quantile FENCE. A text of n
    characters may be 1 + SHORT / n times as far from the median as the fence,
    in logarithms, since few characters say little. A language (or null) with fewer than
    MIN_CALIBRATE of them takes the quantiles over all languages; without
    enough of those either, everything is kept. Null and empty texts have no
    perplexity and are kept. Rows that repeat are judged alike; rows without an
    id are never trusted.
    """
    trusted = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").alias("ident")).distinct()
    rows = docs.select(col(ident).alias("ident"), col(lang).alias("lang"), col(text).alias("body"))
    # Labels grow with the documents: the join is a sort-merge join at every size, not a broadcast as long as they are few.
    others = _pressed(rows.where(~_calibrating(F.col("ident")) & F.col("body").isNotNull()).select("ident", "body"))
    model = train(others.join(trusted.hint("merge"), "ident", "left_semi").select("body"))
    scored = saved(perplexities(rows.select("ident", "lang", *key_pair(F.col("ident"), F.col("body")), "body"), model), "perplexities")

    logs = scored.where(_calibrating(F.col("ident")) & F.col("perplexity").isNotNull()).join(trusted, "ident", "left_semi").select("lang", F.ln("perplexity").alias("log"))
    quantiles = [F.percentile_approx("log", [0.5, FENCE], 100000).alias("q"), F.count("*").alias("n")]
    enough = F.col("n") >= MIN_CALIBRATE
    overall = logs.agg(*quantiles).where(enough).select("q").first()
    q = F.coalesce("own", F.array(*[F.lit(float(x)) for x in overall["q"]]) if overall else F.lit(None).cast("array<double>"))
    own = logs.groupBy("lang").agg(*quantiles).where(enough).select(F.col("lang").alias("own_lang"), F.col("q").alias("own"))
    found = scored.join(saved(own, "thresholds"), F.col("lang").eqNullSafe(F.col("own_lang")), "left")
    threshold = F.exp(q[0] + (q[1] - q[0]) * (1 + SHORT / F.col("chars")))
    return found.select("k1", "k2", "ident", "lang", "perplexity", F.when(F.col("chars") > 0, threshold).alias("threshold"), F.when(F.col("chars") > 0, F.coalesce(F.col("perplexity") <= threshold, F.lit(True))).otherwise(True).alias("keep"))


def quality_stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier keeps, all their columns."""
    rejected = saved(judged(docs, labels).where("not keep").select("k1", "k2").distinct(), "rejected")
    rows = docs.select(packed(docs), *key_pair(col("doc_id"), col("text")))
    # Rejected rows grow with the documents, so they are never broadcast.
    return unpacked(rows.join(rejected.hint("merge"), ["k1", "k2"], "left_anti"), docs)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select(F.col("ident").alias("doc_id"), "lang", "perplexity", "threshold", "keep")
