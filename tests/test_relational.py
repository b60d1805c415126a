import random

import pytest

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.operators import relational as R


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_keep_first_takes_raw_keys_and_one_null(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("1", 3, "c"), ("01", 4, "d"), ("1", 0, "e")],
                               "id string, seq int, v string")
    out = R.keep_first(df, ["id"], "seq")
    assert {(r.id, r.v) for r in out.collect()} == {(None, "a"), ("1", "e"), ("01", "d")}
    assert {tuple(r) for r in R.keep_first(out, ["id"], "seq").collect()} == {tuple(r) for r in out.collect()}


def test_keep_first_with_one_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                                    (30_000 - F.col("id")).alias("seq"), "id")
    out = R.keep_first(df, ["k"], "seq")
    assert out.count() == 10_001
    assert out.where("k = -1").first().id == 29_999


def test_removed_plus_kept_is_everything(spark, sf):
    events = sf("events")
    kept = R.keep_first(events, ["user_id"], "event_id")
    assert kept.count() + R.exclude_existing(events, kept, ["event_id"]).count() == events.count()


def test_first_wins_union(spark):
    a = spark.createDataFrame([(1, 5), (2, 1)], "id int, position int")
    b = spark.createDataFrame([(2, 0), (3, 9), (4, 2)], "id int, position int")
    known = spark.createDataFrame([(4,)], "id int")
    out = R.first_wins_union([a, b], ["id"], "position", existing=known)
    assert rows(out.select("id", "stage")) == [(1, 1), (2, 1), (3, 2)]
    capped = R.first_wins_union([a, b], ["id"], "position", cap=3)
    assert [r.id for r in capped.orderBy("stage", "position").collect()] == [2, 1, 4]


def test_left_join_null_keys_meet_and_repeated_keys_fan_out(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "id int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "id int, r string")
    out = {(r.l, r.r) for r in R.left_join(left, right, "id").collect()}
    assert out == {("a", "x"), ("a", "y"), ("b", "z"), ("c", None)}
    strict = {(r.l, r.r) for r in R.left_join(left, right, "id", null_safe=False).collect()}
    assert ("b", None) in strict


def test_left_join_keeps_left_rows_when_right_keys_are_unique(spark, sf):
    part, docs = sf("part"), sf("documents")
    assert R.left_join(part, docs, "p_partkey", "doc_id").count() == part.count()


def test_lookup_code(spark):
    names = spark.createDataFrame([(" Action\t",), ("77",), ("nope",), (None,)], "n string")
    codes = spark.createDataFrame([("action", 28)], "name string, code int")
    assert rows(R.lookup_code(names, "n", codes, "name", "code")) == [(" Action\t", 28), ("77", 77)]


def test_group_quota():
    assert [R.group_quota(1000, 10), R.group_quota(20, 10)] == [100, 5]


def test_top_n_pruned_equals_a_full_sort(spark):
    rng = random.Random(5)
    data = [(f"t{i:05d}", int(rng.paretovariate(0.6))) for i in range(4000)]
    df = spark.createDataFrame(data, "term string, cf long")
    for n in (1, 10, 500, 3999, 9000):
        expected = sorted(data, key=lambda r: (-r[1], r[0]))[:n]
        assert [tuple(r) for r in R.top_n_pruned(df, "cf", "term", n).collect()] == expected


def test_resolve_tags(spark):
    queries = spark.createDataFrame([("q1",), ("q2",), ("q3",), ("q4",)], "q string")
    candidates = spark.createDataFrame(
        [("q1", 10, 1), ("q1", 11, 2), ("q1", 12, 3), ("q1", 13, 4), ("q1", 14, 5), ("q1", 15, 6), ("q2", 20, 1),
         ("q2", 21, 2), ("q3", 30, 1), ("q3", 31, 2)], "q string, tag int, position int")
    items = spark.createDataFrame([([11, 12, 15],), ([12, 11, 15, 11],), ([15, 30],)], "tags array<int>")
    fixed = spark.createDataFrame([("q3", 99)], "q string, tag int")
    out = rows(R.resolve_tags(queries, "q", candidates, items, "tags", fixed))
    # 11 and 12 cover two items each: the earlier wins. 15 covers three, but is the sixth candidate.
    assert out == [("q1", 11, 2), ("q2", 20, 0), ("q3", 99, None), ("q4", None, None)]


@pytest.mark.parametrize("n", [1, 7, 40, 2000])
def test_large_quotas_equal_a_window(spark, monkeypatch, n):
    monkeypatch.setattr(R, "WINDOW_PRUNE_LIMIT", 3)
    monkeypatch.setattr(R, "BINS", 4)
    rng = random.Random(n)
    values = [None, float("nan"), float("inf"), -float("inf"), 0.0, 1e300, -1e300] + [float(rng.randrange(12)) for _ in range(40)]
    rows = [(rng.choice(["a", "a", "a", "a", "b", None]), rng.choice(values), i) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, v double, i long").repartition(5)
    for descending in (False, True):
        order = [F.desc("v") if descending else F.asc("v"), F.asc("i")]
        want = df.withColumn("rank", F.row_number().over(W.partitionBy("g").orderBy(*order)).cast("bigint")).where(F.col("rank") <= n)
        got = R.first_per_group(df, ["g"], "v", n, [F.asc("i")], descending)
        key = lambda r: str(tuple(r))
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    every = R.numbered(df, [], [F.asc("i")], "place").collect()
    assert sorted((r.i, r.place) for r in every) == [(i, i + 1) for i in range(700)]


def test_the_histogram_leaves_few_rows_of_a_large_group(spark):
    df = spark.range(200_000).select((F.col("id") % 10 == 0).alias("g"), (F.xxhash64("id") % 1_000_000).cast("double").alias("v"))
    left = R.near_the_top(df, ["g"], "v", 2000)
    sizes = {r.g: r["count"] for r in left.groupBy("g").count().collect()}
    assert all(2000 <= n <= 4500 for n in sizes.values())


@pytest.mark.parametrize("both", [(10_000, 10_000), (100, 0), (0, 100)])
def test_rows_without_a_key_are_refused_or_split(spark, both):
    lefts, rights = both
    left = spark.range(lefts + 5).select(F.when(F.col("id") < 5, F.col("id")).alias("k"), F.col("id").alias("l"))
    right = spark.range(rights + 5).select(F.when(F.col("id") < 5, F.col("id") + 3).alias("k"), F.col("id").alias("r"))
    assert R.null_pairs(left, right, "k") == (lefts, rights)
    bound = 1_000_000
    if lefts * rights > bound:
        with pytest.raises(R.FanOut):
            R.left_join(left, right, "k", max_pairs=bound, on_excess="raise")
    out = R.left_join(left, right, "k", max_pairs=bound)
    assert out.columns == ["k", "l", "r"]
    row = out.agg(F.count("*").alias("n"), F.count_if(F.expr("k is null")).alias("nulls"), F.count_if(F.expr("k is not null and r is not null")).alias("met")).first()
    assert (row.nulls, row.met) == (lefts * max(rights, 1), 2) and row.n == row.nulls + 5


@pytest.mark.parametrize("lefts, rights, bound", [(3000, 40, 100), (40, 3000, 100), (300_000, 30_000, 50_000), (7, 9, 5), (1, 900, 50)])
def test_the_grid_of_rows_without_a_key_keeps_the_bound_with_few_copies(lefts, rights, bound):
    rows, columns = R._grid(lefts, rights, bound)
    assert -(-lefts // rows) * -(-rights // columns) <= bound
    # Dealing the right rows alone copied every left row once for each of lefts * rights / bound parts.
    assert lefts * columns + rights * rows <= 4 * max(lefts * rights / bound ** 0.5, lefts + rights)


def test_more_left_rows_without_a_key_than_a_task_may_pair(spark):
    left = spark.range(3000).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("l"))
    right = spark.range(40).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("r"))
    out = R.left_join(left, right, "k", max_pairs=100)
    row = out.agg(F.count("*").alias("n"), F.countDistinct("l", "r").alias("different")).first()
    assert (row.n, row.different) == (120_000, 120_000)


def test_null_keys_split_makes_a_row_per_customer_and_not_per_order(spark, tmp_path, monkeypatch):
    from lakeloom.suite import rows as suite_rows
    orders = spark.range(6000).select(F.col("id").alias("o_orderkey"), F.when(F.col("id") % 5 > 0, F.col("id") % 100).alias("o_custkey"))
    customer = spark.range(600).select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), "id").alias("c_name"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    customer.write.parquet(f"{tmp_path}/customer.parquet")
    joins, join = [], R.left_join
    monkeypatch.setattr(suite_rows.R, "left_join", lambda *args, **kw: joins.append(join(*args, **kw)) or joins[-1])
    found = {r.cust: (r.pairs, r.matched, r.last_name) for r in suite_rows.null_keys_split(spark, str(tmp_path)).collect()}
    lefts = orders.where("o_orderkey % 3 = 0 or o_custkey is null").count()
    assert found[None] == (lefts * 200, lefts * 200, "c99")
    assert found[3] == (40, 0, None) and found[4][1:] == (found[4][0], "c4")
    assert sum(j.count() for j in joins) <= 6000 + 600
