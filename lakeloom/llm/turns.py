"""Conversations as tables of turns: reading, global order and runs of a conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import materialise

#: Bits of a place in a partition that one block covers: 4,096 neighbouring rows.
BLOCK_BITS = 12


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def ordered(rows: DataFrame, columns: list[str], purpose: str) -> DataFrame:
    """``rows`` stored in the order of ``columns`` (nulls first), with ``_at``, which ascends along that order.

    Rows are cut into ranges of all ``columns`` together, so that a group that
    holds much of the table lies in many tasks.
    """
    order = [F.col(c).asc_nulls_first() for c in columns]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), purpose)


def block_of(at: str = "_at"):
    """Number of the block that a row of an ordered table lies in: at most 4,096 rows, all in one partition."""
    return F.shiftright(at, BLOCK_BITS)
