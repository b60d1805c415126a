"""Incremental ingestion of landed records (ST1, ST2, D4)."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators.relational import keep_first
from lakeloom.operators.shaping import has_identity, metadata_rows, review_rows
from lakeloom.session import materialise
from lakeloom.sources import versions
from lakeloom.sources.schemas import BRONZE, LANDING
from lakeloom.sources.writers import append_batch, key_ledger

ON_DEMAND_REVIEW_LENGTH = 20


def landing_stream(spark: SparkSession, path: str, schema: T.StructType = LANDING,
                   files_per_batch: int | None = None) -> DataFrame:
    """S9 as a stream: JSON records dropped into a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def dedup_stream(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """ST2: drop repeated keys that arrive within ``delay`` of each other.

    The state Spark keeps is bounded by the watermark, and so rows that arrive
    later than ``delay`` behind the newest time are dropped, whatever their
    key: ``late_rows`` counts them. Where none may be lost, ``settle_stream``
    compares with the ledger of all keys instead.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the recent batches of a query dropped for being behind its watermark."""
    return sum(state["numRowsDroppedByWatermark"] for progress in query.recentProgress for state in progress["stateOperators"])


def start_append(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, str], None]) -> StreamingQuery:
    """Run ``write`` on everything that is available, in micro-batches, then stop.

    ``write`` gets the batch and its token, which is the same when the batch is
    replayed and differs between streams: the stream id Spark keeps in the
    checkpoint, and the batch number.
    """
    def run(batch: DataFrame, number: int) -> None:
        stream_id = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        write(batch, f"{stream_id.replace('-', '')}.{number}")

    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def append_new(batch: DataFrame, path: str, key: str, token: str) -> None:
    """Append the rows whose key the text table lacks; the same token again changes nothing."""
    ledger = key_ledger(batch.sparkSession, path, batch.columns, key, without=token)
    append_batch(ledger.exclude(batch, without=token), path, token, key)


@dataclass
class LateCounts:
    """What has arrived behind the watermark so far: rows, and of them the ones whose key was new."""

    late: int
    settled: int
    high: str | None


def late_counts(spark: SparkSession, path: str) -> LateCounts:
    """Late rows of the stream that ``append_settled`` writes to ``path``, over its whole life."""
    version = versions.current(spark, f"{path}_watermark")
    if version is None:
        return LateCounts(0, 0, None)
    tokens = version.note["tokens"]
    return LateCounts(version.note["late"] + sum(t[0] for t in tokens.values()),
                      version.note["settled"] + sum(t[1] for t in tokens.values()), version.note["high"])


def append_settled(batch: DataFrame, path: str, key: str, time: str, delay: str, token: str) -> None:
    """ST2 without loss: append the rows with a new key, whether in time or late; the same token again changes nothing.

    Rows more than ``delay`` behind the newest ``time`` of the batches before
    are late: they go to the side table ``path_late`` as they came, and the
    ledger of all keys, not a bounded state, decides which of them are new.
    The first row of a key in the batch counts, in-time rows before late ones.
    ``late_counts`` adds up what was late. A replayed batch may find another
    watermark; rows then change sides, the table does not.
    """
    spark = batch.sparkSession
    version = versions.current(spark, f"{path}_watermark")
    note = version.note if version else {"high": None, "late": 0, "settled": 0, "tokens": {}}
    ledger = key_ledger(spark, path, batch.columns, key, without=token)
    when = F.col(time).try_cast("timestamp")
    line = F.lit(note["high"]).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    is_late = F.coalesce(when < line, F.lit(False))
    rows = materialise(batch.withColumns({"_late": is_late, "_place": F.monotonically_increasing_id()}), "arrived")
    side = rows.where("_late").select(*batch.columns)
    append_batch(side, f"{path}_late", token)
    first = keep_first(rows, [key], F.struct("_late", "_place"))
    new = materialise(ledger.exclude(first, without=token, asked=rows), "settled")
    append_batch(new.select(*batch.columns), path, token, key)
    high, late = rows.agg(F.date_format(F.max(when), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.count_if("_late")).first()
    tokens = {**note["tokens"], token: [late, new.where("_late").count()]}
    done = list(tokens)[:-1]
    # Only the newest batch may be replayed; the counts of older ones are added up.
    older = [tokens.pop(t) for t in done]
    added = [sum(t[i] for t in older) for i in (0, 1)]
    highs = [h for h in (note["high"], high) if h]
    versions.publish_note(spark, f"{path}_watermark", {
        "high": max(highs) if highs else None, "late": note["late"] + added[0], "settled": note["settled"] + added[1], "tokens": tokens})


def settle_stream(stream: DataFrame, path: str, key: str, time: str, delay: str, checkpoint: str) -> StreamingQuery:
    """ST2 as a stream: ``append_settled`` for every batch that is available."""
    return start_append(stream, checkpoint, lambda batch, token: append_settled(batch, path, key, time, delay, token))


def micro_ingest(spark: SparkSession, landing: str, bronze_dir: str, checkpoint: str,
                 skip_known: bool = True, files_per_batch: int | None = None,
                 schema: T.StructType = LANDING) -> StreamingQuery:
    """ST1: append arriving records to the metadata and review tables, once per batch.

    ``skip_known`` leaves out ids the metadata table already holds and repeats
    within the batch.
    """
    stream = landing_stream(spark, landing, schema, files_per_batch).select(
        "*", F.col("_metadata.file_path").alias("_file"))

    def write(batch: DataFrame, token: str) -> None:
        records = has_identity(batch)
        if skip_known:
            placed = records.withColumn("_place", F.monotonically_increasing_id())
            records = keep_first(placed, ["id"], F.struct("_file", "_place"))
            path = f"{bronze_dir}/movies_metadata"
            ledger = key_ledger(batch.sparkSession, path, BRONZE["movies_metadata"], "id", ["media_type"], True, without=token)
            records = ledger.exclude(records, without=token)
        records = records.persist()
        try:
            # The metadata decide what counts as known, so they are written last.
            reviews = review_rows(records, longer_than=ON_DEMAND_REVIEW_LENGTH, flatten_first=True)
            append_batch(reviews, f"{bronze_dir}/reviews", token)
            append_batch(metadata_rows(records), f"{bronze_dir}/movies_metadata", token, "id", ["media_type"], True)
        finally:
            records.unpersist()

    return start_append(stream, checkpoint, write)
