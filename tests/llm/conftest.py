"""Corpora written as tables."""

import pytest
from corpora import SCHEMA
from pyspark.sql import functions as F


@pytest.fixture
def stored(spark, tmp_path):
    """Write (doc_id, text) rows as a documents table and return its folder."""
    def write(rows, name="sf", parts=3, labels=(), benchmark=()):
        folder = str(tmp_path / name)
        full = [(d, t, "en", f"s{(d or 0) % 3}", len(t or "")) for d, t in rows]
        spark.createDataFrame(full, SCHEMA).repartition(parts).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        return folder
    return write


@pytest.fixture
def clashing(spark):
    """Documents with further columns, named like the helpers' own."""
    def make(folder):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for name in ("row", "level", "name", "group", "kept", "h", "pos", "score", "shard", "tokens", "lines", "key"):
            docs = docs.withColumn(name, F.lit("x"))
        path = f"{folder}/clashing.parquet"
        docs.write.parquet(path)
        return spark.read.parquet(path)
    return make
