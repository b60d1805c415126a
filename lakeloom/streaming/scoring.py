"""Scoring of arriving text (ST3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators.sentiment import SentimentModel
from lakeloom.streaming.ingest import start_append


def score_stream(stream: DataFrame, model: SentimentModel, key: str, text: str, target: str, checkpoint: str,
                 keep: Sequence[str] = ()) -> StreamingQuery:
    """H11 on every micro-batch; a batch owns one folder, so a replay overwrites its own rows."""
    def write(batch: DataFrame, token: str) -> None:
        model.score(batch, key, text, keep=keep).write.mode("overwrite").parquet(f"{target}/batch={token}")

    return start_append(stream, checkpoint, write)
