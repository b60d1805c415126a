"""Repeated passages by content-defined chunks.

A gear hash rolls over the bytes of a text; where it falls under a threshold a
chunk ends, so that the same passage is cut in the same way wherever it
stands, and an insertion moves only the cuts next to it. Chunks with equal
digests are copies: all but the first (by doc_id) are duplicates. Neighbouring
duplicates are joined into spans, and spans long enough not to be chance are
reported or removed.

Most chunks occur once. Which ones do not is found first, with packed arrays
of 64-bit hashes; only repeated chunks become rows with a digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import documents, runs_of, small_batches, text_of, with_row
from lakeloom.llm.ngram_join import RANGE_KEYS, RUN_ROWS, _mix, common_counts
from lakeloom.session import materialise

#: One byte in so many ends a chunk, but not within LEAST bytes of another such byte; the longest chunk; bytes of the hash.
ONE_IN, LEAST, MOST, GEAR_BYTES = 18, 8, 4096, 16
#: Bytes of neighbouring duplicates that follow one earlier text, or several, and count as a repeated passage.
SAME_SOURCE, ANY_SOURCE = 64, 160

_GEAR = (_mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)
_VALUE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))
_FACTOR = 0xD1342543DE82EF95


class Chunker:
    """Ends of chunks and 64-bit hashes of chunks of many texts at once."""

    def __init__(self):
        self._power = self._inverse = np.ones(1, np.uint64)

    def __call__(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text: where its chunks begin, its length last; and a hash for each chunk."""
        out = []
        for run in runs_of(texts):
            out += self._run(run)
        return out

    def _run(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        sizes = [len(t) for t in texts]
        # Before each text there is room for one hash, in which nothing counts: every text starts from the same state.
        flat = np.frombuffer(b"".join(bytes(GEAR_BYTES) + t for t in texts), np.uint8)
        begin = np.cumsum([0] + [n + GEAR_BYTES for n in sizes])[:-1] + GEAR_BYTES
        rolled, width = _GEAR[flat], 1
        for at in begin:
            rolled[at - GEAR_BYTES:at] = 0
        while width < GEAR_BYTES:
            further = rolled.copy()
            further[width:] += rolled[:-width] << np.uint32(width)
            rolled, width = further, width * 2
        mixed = (rolled ^ (rolled >> np.uint32(16))) * np.uint32(0x7FEB352D)
        cut = np.flatnonzero(mixed < np.uint32((1 << 32) // ONE_IN)) + 1
        cut = cut[np.diff(cut, prepend=-LEAST) >= LEAST]
        if len(self._power) < len(flat) + 1:
            for name, factor in (("_power", _FACTOR), ("_inverse", pow(_FACTOR, -1, 1 << 64))):
                row = np.full(len(flat) + 1, factor, np.uint64)
                row[0] = 1
                setattr(self, name, np.cumprod(row, dtype=np.uint64))
        total = np.concatenate((np.zeros(1, np.uint64),
                                np.cumsum(_VALUE[flat] * self._power[:len(flat)], dtype=np.uint64)))
        out = []
        for at, n, first, last in zip(begin, sizes, np.searchsorted(cut, begin, "right"),
                                      np.searchsorted(cut, begin + sizes, "left")):
            edges = np.concatenate(([at], cut[first:last], [at + n])) if n else np.array([at])
            long = np.flatnonzero(np.diff(edges) > MOST)
            if len(long):
                more = [np.arange(edges[i] + MOST, edges[i + 1], MOST) for i in long]
                edges = np.sort(np.concatenate([edges, *more]))
            size = np.diff(edges).astype(np.uint64)
            hashes = _mix((total[edges[1:]] - total[edges[:-1]]) * self._inverse[edges[:-1]] + size)
            out.append((edges - at, hashes))
        return out


def _runs(docs: DataFrame, run_rows: int) -> DataFrame:
    """(run, docs, keys): the chunk hashes of a run of documents, one document after the other."""
    kind = pa.list_(pa.struct([("row", pa.int64()), ("chunks", pa.int32())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunker, rows, keys = Chunker(), [], []

        def emit() -> pa.RecordBatch:
            listed = [[{"row": r, "chunks": len(k)} for r, k in zip(rows, keys)]]
            return pa.RecordBatch.from_arrays(
                [pa.array([rows[0]], pa.int64()), pa.array(listed, kind),
                 pa.array([b"".join(k.tobytes() for k in keys)], pa.binary())], ["run", "docs", "keys"])

        for batch in batches:
            rows += batch.column("_row").to_pylist()
            keys += [h for _, h in chunker([t.encode() for t in batch.column("text").to_pylist()])]
            if len(rows) >= run_rows:
                yield emit()
                rows, keys = [], []
        if rows:
            yield emit()

    return with_row(docs.select(text_of().alias("text")), "_row").mapInArrow(
        task, "run long, docs array<struct<row:long,chunks:int>>, keys binary")


def _repeated(runs: DataFrame, bits: int) -> DataFrame:
    """(_row, wanted): the numbers (packed) of the chunks of a row whose hash occurs again somewhere."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for listed, blob, answers in zip(batch.column("docs").to_pylist(), batch.column("keys").to_pylist(),
                                             batch.column("answers").to_pylist()):
                key = np.frombuffer(blob, np.uint64) >> np.uint64(32 - bits)
                codes = np.frombuffer(b"".join(a["codes"] for a in answers or []), np.uint8)
                again = codes[np.searchsorted(np.unique(key), key)] > 1
                rows, wanted, at = [], [], 0
                for d in listed:
                    found = np.flatnonzero(again[at:at + d["chunks"]])
                    at += d["chunks"]
                    if len(found):
                        rows.append(d["row"])
                        wanted.append(found.astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(wanted, pa.binary())], ["_row", "wanted"])

    return runs.join(common_counts(runs, bits), "run", "left").mapInArrow(task, "_row long, wanted binary")


def repeated_spans(docs: DataFrame, run_rows: int = RUN_ROWS, range_keys: int = RANGE_KEYS,
                   same_source: int = SAME_SOURCE, any_source: int = ANY_SOURCE) -> DataFrame:
    """(_row, doc_id, start_byte, end_byte, first_doc_id, first_row): passages that occur earlier, in the rows of ``docs``.

    ``docs`` (doc_id, text; other columns are ignored) must be a stored table,
    as it is read twice. Earlier is a smaller doc_id (null comes last), then an
    earlier row, then an earlier place in the same text, so that of repeated
    rows the first keeps its text. Positions are bytes in UTF-8, the end
    exclusive. Null and empty texts have no chunks. Hashes of the first step
    only choose candidates; a 128-bit digest decides.
    """
    small_batches(docs.sparkSession)
    runs = materialise(_runs(docs, run_rows), "chunk-runs")
    size = runs.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    bits = max(0, min(32, int(np.ceil(np.log2(max(1, size / 8 / range_keys)))) + 3))
    repeated = materialise(_repeated(runs, bits), "repeated")
    texts = with_row(docs.select("doc_id", text_of().alias("text")), "_row")
    wanted = texts.join(repeated.hint("shuffle_hash"), "_row")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunker = Chunker()
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            columns: list[list] = [[], [], [], [], [], []]
            for row, doc_id, text, (edges, _), blob in zip(
                    batch.column("_row").to_pylist(), batch.column("doc_id").to_pylist(), texts, chunker(texts),
                    batch.column("wanted").to_pylist()):
                for i in np.frombuffer(blob, np.int32).tolist():
                    a, b = int(edges[i]), int(edges[i + 1])
                    for column, value in zip(columns, (row, doc_id, i, a, b, blake2b(text[a:b], digest_size=16).digest())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                ["_row", "doc_id", "i", "a", "b", "digest"])

    chunks = materialise(wanted.select("_row", "doc_id", "text", "wanted").mapInArrow(
        digests, "_row long, doc_id long, i int, a int, b int, digest binary"), "chunks")
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "_row", "i")
    firsts = materialise(chunks.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
                         .where("n > 1").select("digest", "first"), "first-chunks")
    later = (chunks.join(firsts, "digest").where((F.col("_row") != F.col("first._row")) | (F.col("i") != F.col("first.i")))
             .select("_row", "doc_id", "i", "a", "b", F.col("first._row").alias("first_row"),
                     F.col("first.doc_id").alias("first_doc_id"), (F.col("i") - F.col("first.i")).alias("shift")))
    run = F.col("i") - F.row_number().over(Window.partitionBy("_row").orderBy("i"))
    piece = F.col("i") - F.row_number().over(Window.partitionBy("_row", "first_row", "shift").orderBy("i"))
    spans = (later.withColumn("run", run).withColumn("piece", piece)
             .groupBy("_row", "doc_id", "run", "first_row", "first_doc_id", "shift", "piece")
             .agg(F.min("a").alias("start_byte"), F.max("b").alias("end_byte"), F.sum(F.col("b") - F.col("a")).alias("bytes")))
    together = F.sum("bytes").over(Window.partitionBy("_row", "run"))
    return (spans.withColumn("together", together)
            .where((F.col("bytes") >= same_source) | (F.col("together") >= any_source))
            .select("_row", "doc_id", F.col("start_byte").cast("long").alias("start_byte"),
                    F.col("end_byte").cast("long").alias("end_byte"), "first_doc_id", "first_row"))


def drop_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (a stored table) with the repeated passages cut out of ``text``; other columns stay."""
    spans = repeated_spans(docs, **options).groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("start_byte", "end_byte"))).alias("_spans"))
    joined = with_row(docs, "_row").join(materialise(spans, "spans").hint("shuffle_hash"), "_row", "left").drop("_row")
    schema, place = joined.drop("_spans").schema, docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(place).to_pylist(), batch.column("_spans").to_pylist()):
                if spans:
                    data, kept, at = text.encode(), [], 0
                    for s in spans:
                        kept.append(data[at:max(at, s["start_byte"])])
                        at = max(at, s["end_byte"])
                    # A chunk may end inside a character; what is left of such a one goes as well.
                    text = b"".join([*kept, data[at:]]).decode(errors="ignore")
                texts.append(text)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(cut, schema)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(documents(spark, sf_dir)).drop("_row", "first_row")
