"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewell.llm.common import col, read, saved, small_batches

BUCKETS = 1 << 14  # n-grams of one to three characters hash into so many features
ROWS_PER_LANG = 600  # bound of the sample that weights are fitted on, per language
_PIECE = 1 << 19  # characters looked at together
_CALIBRATE = 5  # every fifth sampled row fits the temperature, the others the weights


def features(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of hashed 1- to 3-grams of the lower-cased text, letters and blanks only (all else counts as one blank)."""
    counts = np.zeros(buckets, np.int64)
    low = text.lower()
    for at in range(0, max(len(low), 1), _PIECE):
        piece = low[max(0, at - 2) : at + _PIECE]
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        codes = np.concatenate((np.zeros(1, np.uint64) if at == 0 else codes[:0], codes, np.zeros(1, np.uint64) if at + _PIECE >= len(low) else codes[:0]))
        codes = np.where((codes < 97) | ((codes > 122) & (codes < 170)), np.uint64(0), codes)
        gram, new = np.zeros(len(codes), np.uint64), min(at, 2)  # the first `new` places were counted with the piece before
        for n in range(1, 4):
            gram = (gram[: len(codes) - n + 1] if n > 1 else gram) * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(n)
            if len(gram) == 0:
                break
            skip = max(0, new - n + 1)
            mixed = (gram[skip:] ^ (gram[skip:] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            counts += np.bincount((mixed >> np.uint64(64 - int(buckets).bit_length() + 1)).astype(np.int64), minlength=buckets)
    return counts


@dataclass
class Model:
    """langs in order; weights[bucket, lang]; bias; idf[bucket]; temperature."""

    langs: list[str]
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    temperature: float

    def vector(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices and values of the TF-IDF vector, of length 1."""
        at = np.flatnonzero(counts)
        x = (1 + np.log(counts[at])) * self.idf[at]
        return at, x / max(np.sqrt((x * x).sum()), 1e-12)

    def scores(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        z = (x @ self.weights[at] + self.bias) / self.temperature
        z = np.exp(z - z.max())
        return z / z.sum()


def fit(rows: list[tuple[np.ndarray, np.ndarray]], langs: list[str], labels: np.ndarray, idf: np.ndarray, epochs: int = 4,
        alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-2, l2: float = 1e-3) -> Model:
    """Follow-the-regularised-leader with elastic net (l1, l2), then the temperature by bisection on rows kept back."""
    n_langs = len(langs)
    z, n = np.zeros((len(idf) + 1, n_langs)), np.zeros((len(idf) + 1, n_langs))  # the last row is the bias

    def current(at: np.ndarray) -> np.ndarray:
        over = np.abs(z[at]) - l1
        return np.where(over > 0, -np.sign(z[at]) * over / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    train = [i for i in range(len(rows)) if i % _CALIBRATE] or list(range(len(rows)))
    held = [i for i in range(len(rows)) if not i % _CALIBRATE]
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(train):
            at, x = rows[i]
            at, x = np.append(at, len(idf)), np.append(x, 1.0)
            w = current(at)
            p = x @ w
            p = np.exp(p - p.max())
            p /= p.sum()
            p[labels[i]] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    weights = current(np.arange(len(idf) + 1))
    model = Model(langs, weights[:-1], weights[-1], idf, 1.0)
    logits = [(x @ model.weights[at] + model.bias, labels[i]) for i in held for at, x in [rows[i]]]
    if logits:
        zs, ys = np.array([a for a, _ in logits]), np.array([b for _, b in logits])
        # Rows that are all told apart would drive the temperature to 0: as in
        # Platt's scaling, each label counts a little less than whole.
        rest = 1 / (len(ys) + 2)
        wanted = (1 - rest) * zs[np.arange(len(ys)), ys] + rest * zs.mean(axis=1)

        def slope(log_t: float) -> float:
            """Of the mean log loss, by the inverse temperature."""
            s = zs * np.exp(-log_t)
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            return float(((p * zs).sum(axis=1) - wanted).mean())

        low, high = np.log(0.05), np.log(20.0)
        for _ in range(40):  # a higher inverse temperature helps as long as the slope is below 0
            mid = (low + high) / 2
            low, high = (low, mid) if slope(mid) < 0 else (mid, high)
        model.temperature = float(np.exp((low + high) / 2))
    return model


def held_out(ident: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(col(ident).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, lang: str = "lang", text: str = "text", ident: str = "doc_id", rows_per_lang: int = ROWS_PER_LANG, buckets: int = BUCKETS) -> Model | None:
    """Learns from the given rows with a text and a lang; None if there are none.

    Document frequencies are counted over all of them, each task summing its
    rows first. The weights are fitted on at most `rows_per_lang` rows of each
    language, those with the least hash of id and text; their sparse vectors
    (at most `buckets` numbers each) are all that reaches the driver.
    """
    spark = docs.sparkSession
    small_batches(spark)
    usable = docs.select(col(lang).alias("lang"), col(text).alias("body"), col(ident).cast("string").alias("ident")).where("lang is not null and body is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for body in batch.column("body").to_pylist():
                total += features(body, buckets) > 0
                n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, buckets)), pa.array(np.append(n, total))], names=["bucket", "n"])

    counted = usable.select("body").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    if not len(counted):
        return None
    df = np.zeros(buckets + 1)
    df[counted["bucket"].to_numpy() + 1] = counted["n"].to_numpy()
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1

    hashed = usable.withColumn("at", F.xxhash64("ident", "body"))
    # Rows alike in id and text are one. Where a language has many, a limit on the hash, set by their number, leaves
    # about twice as many as are wanted, so what is ranked is bounded whatever the table and however it is split.
    several = saved(hashed.select("lang", "at").distinct(), "sample-hashes")
    share = F.least(F.lit(1.0), 2.0 * rows_per_lang / F.count("*"))
    limit = F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise((F.lit(-float(1 << 63)) + share * float(1 << 64)).cast("long"))
    limits = saved(several.groupBy("lang").agg(limit.alias("limit")), "sample-limits")  # its size decides how it is joined
    few = several.join(limits, "lang").where(F.col("at") <= F.col("limit")).select("lang", "at")
    ranked = few.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("at"))).where(F.col("n") <= rows_per_lang).select("at", "lang")
    sample = hashed.join(saved(ranked, "sample"), ["at", "lang"]).groupBy("at", "lang").agg(F.first("body").alias("body"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blank = Model([], np.zeros((0, 0)), np.zeros(0), idf, 1.0)
        for batch in batches:
            found = [blank.vector(features(body, buckets)) for body in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("at"), pa.array([a.astype(np.int32) for a, _ in found], pa.list_(pa.int32())), pa.array([x.astype(np.float32) for _, x in found], pa.list_(pa.float32()))],
                names=["lang", "at", "i", "x"],
            )

    rows: pd.DataFrame = sample.select("lang", "at", "body").mapInArrow(vectors, "lang string, at long, i array<int>, x array<float>").toPandas()
    rows = rows.sort_values(["at", "lang"])
    langs = sorted(rows["lang"].unique())
    labels = rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
    return fit([(np.asarray(i), np.asarray(x, dtype=np.float64)) for i, x in zip(rows["i"], rows["x"], strict=True)], langs, labels, idf)


def identify(docs: DataFrame, model: Model | None, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Per row: ident (the id), lang_pred, score (calibrated probability).

    `und` with score 0 for a null text, one without a letter, or without a
    model. Whole texts are read; rows that repeat give equal results.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    letters = F.coalesce(col(text).rlike(r"\p{L}"), F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            langs, scores = [], []
            for body, good in zip(batch.column("body").to_pylist(), batch.column("letters").to_pylist(), strict=True):
                if own is None or not good:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                p = own.scores(*own.vector(features(body, len(own.idf))))
                langs.append(own.langs[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([batch.column("ident"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["ident", "lang_pred", "score"])

    rows = docs.select(col(ident).alias("ident"), col(text).alias("body"), letters.alias("letters"))
    return rows.mapInArrow(run, f"ident {docs.schema[ident].dataType.simpleString()}, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), train(docs.where(~held_out())))
    return found.select(F.col("ident").alias("doc_id"), held_out("ident").alias("held_out"), "lang_pred", "score")
