"""Quality: a byte-level convolutional network, written in numpy.

A text is a row of bytes. Learned filters slide over it in overlapping chunks
that cover it to the end; a filter's largest response in a chunk is kept. The
largest and the mean response over the chunks of a text go into one logistic
unit. Next to its embedding, a byte carries how many of the bytes just before
it repeat the ones a few places earlier, so that filters can see repetition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import documents, extended, small_batches
from lakeloom.llm.toxicity import held_out, labelled_sample
from lakeloom.session import materialise

#: Numbers per byte, bytes and number of filters, distance of filter positions, positions of a chunk.
EMBEDDING, WIDTH, FILTERS, STRIDE, STEP = 6, 10, 24, 2, 512
#: Bound on the labelled texts that are fitted, passes over them, and texts laid out at once (bytes).
SAMPLE_ROWS, EPOCHS, RUN_BYTES = 3000, 5, 400_000
#: Bytes of a training text that are fitted (evenly spread if it has more), and bytes of a text that are scored at once.
TRAIN_BYTES, SEGMENT = 131_072, 262_144
#: Places back at which repetition is looked for, and over how many bytes it is counted.
BACK, OVER = range(3, 21), 24
THRESHOLD = 0.3


class Cnn:
    """Parameters, forward pass and training."""

    def __init__(self, parameters: dict[str, np.ndarray] | None = None, seed: int = 11):
        if parameters is None:
            rng = np.random.default_rng(seed)
            inputs = EMBEDDING + 1
            parameters = {
                "emb": rng.normal(0, 0.5, (256, EMBEDDING)), "w": rng.normal(0, 1 / np.sqrt(WIDTH * inputs), (WIDTH * inputs, FILTERS)),
                "b": np.zeros(FILTERS), "v": rng.normal(0, 0.2, 2 * FILTERS), "c": np.zeros(1)}
        self.p = {k: np.asarray(v, np.float32) for k, v in parameters.items()}

    def layout(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all texts (padded to whole chunks, with room for a filter after each), marks of real bytes, chunks per text."""
        chunks = np.array([(len(t) + WIDTH + STEP - 1) // STEP for t in texts])
        flat = np.zeros(int(chunks.sum()) * STEP + WIDTH, np.uint8)
        real = np.zeros(len(flat), np.bool_)
        begin = 0
        for t, n in zip(texts, chunks):
            flat[begin:begin + len(t)] = np.frombuffer(t, np.uint8)
            real[begin:begin + len(t)] = True
            begin += int(n) * STEP
        return flat, real, chunks

    def inputs(self, flat: np.ndarray, real: np.ndarray) -> np.ndarray:
        """One row per byte: its embedding, and the largest share of repeated bytes before it over all distances."""
        x = np.empty((len(flat), EMBEDDING + 1), np.float32)
        x[:, :EMBEDDING] = self.p["emb"][flat]
        best = np.zeros(len(flat), np.int16)
        for back in BACK:
            same = np.zeros(len(flat), np.int16)
            same[back:] = (flat[back:] == flat[:-back]) & real[back:]
            total = np.cumsum(same, dtype=np.int32)
            total[OVER:] -= total[:-OVER].copy()
            np.maximum(best, total, out=best, casting="unsafe")
        x[:, EMBEDDING] = best / OVER
        x[~real] = 0
        return x

    def chunk_features(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Responses per chunk and filter, where they are, chunks per text, the inputs and the bytes."""
        flat, real, chunks = self.layout(texts)
        x = self.inputs(flat, real)
        rows = np.lib.stride_tricks.sliding_window_view(x.reshape(-1), WIDTH * x.shape[1])[::STRIDE * x.shape[1]]
        rows = rows[:int(chunks.sum()) * STEP // STRIDE]
        out = np.empty((int(chunks.sum()), FILTERS), np.float32)
        at = np.empty((int(chunks.sum()), FILTERS), np.int64)
        per = STEP // STRIDE
        for c in range(0, len(out), 64):
            z = rows[c * per:(c + 64) * per] @ self.p["w"] + self.p["b"]
            z[~real[c * STEP:c * STEP + len(z) * STRIDE:STRIDE]] = 0
            z = np.maximum(z, 0).reshape(-1, per, FILTERS)
            best = z.argmax(1)
            at[c:c + 64] = best + per * np.arange(c, c + len(z))[:, None]
            out[c:c + 64] = np.take_along_axis(z, best[:, None], 1)[:, 0]
        return out, at, chunks, x, flat

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """One number per text. Long texts are scored in segments that overlap by a filter."""
        top, total = np.zeros((len(texts), FILTERS), np.float32), np.zeros((len(texts), FILTERS), np.float32)
        count = np.zeros(len(texts), np.int64)
        parts = [(i, t[s:s + SEGMENT + WIDTH - 1]) for i, t in enumerate(texts) for s in range(0, max(len(t), 1), SEGMENT)]
        first = 0
        while first < len(parts):
            last, size = first, 0
            while last < len(parts) and (last == first or size + len(parts[last][1]) <= RUN_BYTES):
                size += len(parts[last][1])
                last += 1
            h, _, chunks, _, _ = self.chunk_features([t for _, t in parts[first:last]])
            begin, owner = np.cumsum(chunks) - chunks, np.array([i for i, _ in parts[first:last]])
            np.maximum.at(top, owner, np.maximum.reduceat(h, begin))
            np.add.at(total, owner, np.add.reduceat(h, begin))
            np.add.at(count, owner, chunks)
            first = last
        pooled = np.concatenate((top, total / np.maximum(count, 1)[:, None]), 1)
        return (pooled @ self.p["v"] + self.p["c"]).astype(np.float64)

    def gradients(self, texts: list[bytes], label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        h, at, chunks, x, flat = self.chunk_features(texts)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        begin = np.cumsum(chunks) - chunks
        top = np.array([b + h[b:b + n].argmax(0) for b, n in zip(begin, chunks)])
        pooled = np.concatenate((np.take_along_axis(h, top, 0), np.add.reduceat(h, begin) / chunks[:, None]), 1)
        z = pooled @ self.p["v"] + self.p["c"]
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) * weight / len(texts)
        g["v"], g["c"] = pooled.T @ d, d.sum(keepdims=True)
        back = np.repeat(d / chunks, chunks)[:, None] * self.p["v"][None, FILTERS:]
        np.add.at(back, (top, np.arange(FILTERS)[None]), d[:, None] * self.p["v"][None, :FILTERS])
        back = np.where(h > 0, back, 0)
        g["b"] = back.sum(0)
        wide, inputs = self.p["w"].shape[0], x.shape[1]
        for f in range(FILTERS):
            c = np.flatnonzero(back[:, f])
            if not len(c):
                continue
            places = at[c, f, None] * STRIDE + np.arange(WIDTH)
            g["w"][:, f] = back[c, f] @ x[places].reshape(len(c), wide)
            part = back[c, f, None, None] * self.p["w"][:, f].reshape(1, WIDTH, inputs)[:, :, :EMBEDDING]
            np.add.at(g["emb"], flat[places].reshape(-1), part.reshape(-1, EMBEDDING))
        return g

    def fit(self, texts: list[bytes], label: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, batch: int = 32,
            seed: int = 5) -> Cnn:
        """Adam on the logistic loss, classes weighted to equal sums."""
        share = label.mean() if len(label) else 0.5
        if share in (0, 1) or not len(label):
            self.p["v"][:] = 0
            self.p["c"][:] = 12 * share - 6
            return self
        weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share))
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, steps = 0, epochs * -(-len(texts) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for i in range(0, len(order), batch):
                chosen = order[i:i + batch]
                step += 1
                g = self.gradients([texts[j] for j in chosen], label[chosen], weight[chosen])
                now = rate * (1 - step / (steps + 1))
                for k in self.p:
                    m[k] += 0.1 * (g[k] - m[k])
                    s[k] += 0.001 * (g[k] * g[k] - s[k])
                    self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


def spread(text: str) -> bytes:
    """A training text, or evenly spread stretches of it if it is longer than the bound."""
    data = text.encode()
    if len(data) <= TRAIN_BYTES:
        return data
    size = TRAIN_BYTES // 64
    return b"".join(data[int(s):int(s) + size] for s in np.linspace(0, len(data) - size, 64))


def train(docs: DataFrame, labels: DataFrame, train_part: Column, label: str = "quality", limit: int = SAMPLE_ROWS,
          epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Fit on at most ``limit`` labelled documents in one task; the driver gets the parameters alone.

    Null labels do not count; without labels of both classes the result is one constant.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sample = materialise(labelled_sample(docs, labels, label, train_part, limit), "quality-sample")

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted((d, y, spread(t)) for b in batches for d, y, t in zip(b["doc_id"], b["label"], b["text"]))
        net = Cnn().fit([t for _, _, t in rows], np.array([y for _, y, _ in rows], int), epochs=epochs)
        yield pd.DataFrame({"name": list(net.p), "shape": [list(v.shape) for v in net.p.values()],
                            "data": [v.tobytes() for v in net.p.values()]})

    # One task fits the sample, whose rows are bounded by `limit` and whose texts by TRAIN_BYTES.
    found = sample.coalesce(1).mapInPandas(fit, "name string, shape array<int>, data binary").collect()
    return {r["name"]: np.frombuffer(r["data"], np.float32).reshape(r["shape"]).copy() for r in found}


def score(docs: DataFrame, parameters: dict[str, np.ndarray], name: str = "score",
          passed: list[str] | None = None) -> DataFrame:
    """``docs`` with a probability in column ``name`` (replaced if there), the whole text counting; null is empty."""
    small_batches(docs.sparkSession)
    places, schema = extended(docs, f"{name} double", passed)
    shared, place = docs.sparkSession.sparkContext.broadcast(parameters), docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Cnn(shared.value)
        for batch in batches:
            z = net.logits([(t or "").encode() for t in batch.column(place).to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), pa.array(p, pa.float64())], schema.names)

    return docs.mapInArrow(task, schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    parameters = train(docs, labels, ~held_out("doc_id", 5, 0))
    return score(docs, parameters, passed=["doc_id"]).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
