"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed character n-grams present in a text. On a bounded
sample of labelled texts, the log ratio of each feature's smoothed counts in
toxic and in clean texts is taken; a logistic regression is then fitted on the
features multiplied by their ratios. The product of both is one weight per
bucket, and a text scores the sum over its n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import DOCUMENT_COLUMNS, documents, extended, small_batches, text_of
from lakeloom.session import materialise

#: Lengths of the n-grams, buckets (a power of two), and the bound on the labelled texts that are fitted.
SIZES, BUCKET_BITS, SAMPLE_ROWS = (3, 4, 5), 19, 6000
#: Score from which a document counts as toxic.
THRESHOLD = 0.7


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Is the remainder of crc32(doc_id as text) this fold? Null counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == fold


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, limit: int) -> DataFrame:
    """(doc_id, text, label) of at most ``limit`` labelled documents of the training part, chosen by a hash of the id.

    The ids are chosen from the labels alone, so that only a bounded list of
    them meets the texts. Null labels do not count; of repeated ids one row is used.
    """
    chosen = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train)
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    # At most `limit` rows of two numbers.
    found = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(materialise(chosen, "chosen")), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


class Grams:
    """Hashed character n-grams of texts."""

    def __init__(self, sizes: tuple[int, ...] = SIZES, bits: int = BUCKET_BITS):
        self.sizes, self.bits = sizes, bits

    def _run(self, texts: list[str], wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        texts = [" " + t.lower() + " " for t in texts]
        code = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        ends = np.cumsum([len(t) for t in texts])
        rolled, keys = code * np.uint32(2654435761), []
        for size in range(2, max(self.sizes) + 1):
            if len(code) < size:
                break
            rolled = rolled[:len(code) - size + 1]
            rolled = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(2246822519)
            rolled += code[size - 1:] * np.uint32(3266489917)
            if size in self.sizes:
                bucket = rolled ^ (rolled >> np.uint32(13))
                bucket *= np.uint32(2654435769 + 2 * size)
                bucket >>= np.uint32(32 - self.bits)
                at = np.flatnonzero(wanted[bucket]) if wanted is not None else np.arange(len(bucket))
                text = np.searchsorted(ends, at, side="right")
                inside = at + size <= ends[text]
                keys.append(text[inside] << self.bits | bucket[at[inside]])
        keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        keys = keys[np.diff(keys, prepend=-1) != 0]
        return keys >> self.bits, keys & ((1 << self.bits) - 1)

    def __call__(self, texts: list[str], wanted: np.ndarray | None = None, run_chars: int = 1 << 17):
        """(text, bucket) of every n-gram, each pair once; ``wanted`` marks the buckets that matter.

        Texts are taken in runs of about ``run_chars``; a longer one is a run of its own.
        """
        found, first = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
        while first < len(texts):
            last, chars = first, 0
            while last < len(texts) and (last == first or chars + len(texts[last]) <= run_chars):
                chars += len(texts[last])
                last += 1
            text, bucket = self._run(texts[first:last], wanted)
            found.append((text + first, bucket))
            first = last
        return np.concatenate([t for t, _ in found]), np.concatenate([b for _, b in found])


def fit_weights(rows: list[np.ndarray], label: np.ndarray, bits: int, epochs: int = 12, alpha: float = 1.0,
                penalty: float = 1e-4, seed: int = 7) -> np.ndarray:
    """Weights per bucket, the intercept last, for texts given as their buckets. Zeros if a class is missing."""
    size = 1 << bits
    weights = np.zeros(size + 1)
    base = np.clip(label.mean(), 0.001, 0.999) if len(label) else 0.001
    weights[-1] = np.log(base / (1 - base))
    if not len(label) or label.min() == label.max():
        return weights
    # Log-count ratios. The class with more texts is scaled to the other.
    counts = np.zeros((2, size))
    for buckets, y in zip(rows, label):
        counts[y][buckets] += 1
    rate = [(counts[y] + alpha) / ((label == y).sum() + 2 * alpha) for y in (0, 1)]
    ratio = np.log(rate[1] / rate[0])
    # A feature is used where its ratio exceeds what chance gives it: two standard errors of a log ratio.
    noise = np.sqrt(1 / (counts[1] + alpha) + 1 / (counts[0] + alpha))
    ratio = np.where(np.abs(ratio) > 2 * noise, ratio, 0)
    rows = [b[ratio[b] != 0] for b in rows]
    rng = np.random.default_rng(seed)
    coef, grad2 = np.zeros(size), np.full(size, 1e-8)
    bias, bias2 = weights[-1], 1e-8
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            b = rows[i]
            x = ratio[b]
            z = bias + coef[b] @ x
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[i]
            step = g * x + penalty * coef[b]
            grad2[b] += step * step
            coef[b] -= 0.1 * step / np.sqrt(grad2[b])
            bias2 += g * g
            bias -= 0.1 * g / np.sqrt(bias2)
    weights[:-1] = coef * ratio
    weights[-1] = bias
    return weights


def train(docs: DataFrame, labels: DataFrame, train_part: Column, label: str = "toxic",
          limit: int = SAMPLE_ROWS, bits: int = BUCKET_BITS) -> np.ndarray:
    """Fit on at most ``limit`` labelled documents; what reaches the driver is one weight per bucket."""
    spark = docs.sparkSession
    small_batches(spark)
    sample = labelled_sample(docs, labels, label, train_part, limit)

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Grams(bits=bits)
        for batch in batches:
            text, bucket = find(list(batch["text"]))
            cuts = np.searchsorted(text, np.arange(1, len(batch)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"],
                                "buckets": [b.astype("<i4").tobytes() for b in np.split(bucket, cuts)]})

    features = materialise(sample.mapInPandas(grams, "doc_id long, label int, buckets binary"), "toxic-sample")

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted((d, y, b) for batch in batches for d, y, b in zip(batch["doc_id"], batch["label"], batch["buckets"]))
        weights = fit_weights([np.frombuffer(b, "<i4") for _, _, b in rows], np.array([y for _, y, _ in rows], int), bits)
        yield pd.DataFrame({"weights": [weights.astype("<f4").tobytes()]})

    # One task fits the sample, whose rows are bounded by `limit`.
    model = features.coalesce(1).mapInPandas(fit, "weights binary").first()
    return np.frombuffer(model["weights"], "<f4").copy()


def score(docs: DataFrame, weights: np.ndarray, name: str = "score", passed: list[str] | None = None) -> DataFrame:
    """``docs`` with a probability in column ``name`` (replaced if there), the whole text counting; null is empty."""
    spark = docs.sparkSession
    small_batches(spark)
    places, schema = extended(docs, f"{name} double", passed)
    shared, bits, place = spark.sparkContext.broadcast(weights), int(np.log2(len(weights) - 1)), docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, w = Grams(bits=bits), shared.value
        wanted = w[:-1] != 0
        for batch in batches:
            text, bucket = find([t or "" for t in batch.column(place).to_pylist()], wanted)
            z = np.bincount(text, weights=w[bucket], minlength=batch.num_rows)
            p = 1 / (1 + np.exp(-np.clip(z + float(w[-1]), -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), pa.array(p, pa.float64())], schema.names)

    return docs.mapInArrow(task, schema)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str, passed: list[str] | None = None) -> DataFrame:
    """``docs`` (doc_id, text and more) with held_out, score and predicted, learnt from the labels of the training part."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    weights = train(documents(spark, sf_dir), labels, ~held_out("doc_id", 3, 1))
    return (score(docs, weights, passed=passed).withColumn("held_out", held_out("doc_id", 3, 1))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return classify(spark, docs, sf_dir, ["doc_id"]).select("doc_id", "held_out", "score", "predicted")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return classify(spark, docs.select(*DOCUMENT_COLUMNS), sf_dir).where("predicted = 0").select(*DOCUMENT_COLUMNS)
