import random

import pytest

from lakeloom.llm.common import components, sorted_names, with_row


def test_components_of_random_graphs_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)] + [(7, 7), (5000, 4000), (4000, 5000)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: root(n) for a, b in edges if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_names_are_dense_ranks(spark, parts):
    keys = [(i * 7919 % 1000, -i) for i in range(500)]
    got = {(r.a, r.b): r.name for r in
           sorted_names(spark.createDataFrame(keys, "a long, b long").repartition(parts), ["a", "b"], "name").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_row_numbers_do_not_depend_on_how_files_are_cut(spark, tmp_path):
    path = str(tmp_path / "a b%")
    spark.range(3000).selectExpr("id", "repeat('x', 50) AS text").repartition(4).write.option("parquet.block.size", "4096").parquet(path)
    numbers, parts, old = [], [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "2k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            docs = with_row(spark.read.parquet(path).select("id"), "_row")
            parts.append(docs.rdd.getNumPartitions())
            numbers.append({r.id: r._row for r in docs.collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert parts[0] != parts[1] and docs.columns == ["id", "_row"]
    assert numbers[0] == numbers[1] and len(set(numbers[0].values())) == 3000
