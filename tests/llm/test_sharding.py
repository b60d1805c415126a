from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import sharding
from corpora import corpus


def test_contract(spark, stored):
    rows = corpus(3) + [(i, "x") for i in range(1000, 6000)]
    got = sharding.op6_sharding(spark, stored(rows)).collect()
    assert len(got) == len(rows)
    texts = {d: t or "" for d, t in rows if d is not None}
    for r in got:
        if r.doc_id is not None:
            raw = texts[r.doc_id].encode()
            assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, crc32(raw), "key")
        assert 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r.grown_shard == 16 for r in got) / len(got)
    assert 0.03 < moved < 0.09
    assert max(Counter(r.shard for r in got).values()) < 2 * len(got) / 16
    assert sharding.op6_sharding(spark, stored([], "none")).count() == 0


def test_weights_shape_the_draw_and_confine_movement(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    layout = {"a": {"a1": {0: 1.0, 1: 3.0}, "a2": {2: 2.0}}, "b": {"b1": {3: 2.0}}, "c": {"c1": {4: 0.0}}}
    other = {"a": {"a1": {0: 1.0, 1: 3.0}, "a2": {2: 2.0}}, "b": {"b1": {3: 4.0}}, "c": {"c1": {4: 0.0}}}
    placed = ids.select(sharding.place(F.col("doc_id"), layout).alias("x"), sharding.place(F.col("doc_id"), other).alias("y"))
    counts = Counter((r.x, r.y) for r in placed.collect())
    share = Counter()
    for (x, _), n in counts.items():
        share[x] += n / 20_000
    assert all(abs(share[s] - w) < 0.02 for s, w in {0: 1 / 8, 1: 3 / 8, 2: 2 / 8, 3: 2 / 8, 4: 0}.items())
    assert all(x == y or y == 3 for x, y in counts)
    with pytest.raises(ValueError):
        sharding.place(F.col("doc_id"), {"a": {"b": {0: 0.0}}})


def test_numbering_by_chunks(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS s", "id % 50 AS k")
    out = sharding.numbered(rows, "s", ["k"], "n", 7).groupBy("s").agg(F.sort_array(F.collect_list("n")).alias("n")).collect()
    assert all(r.n == list(range(len(r.n))) for r in out)
