import pytest
from pyspark.sql import functions as F

from lakeloom.session import drop_work, materialise, shared_root, work_path
from lakeloom.sources import readers as R
from lakeloom.sources import writers as W


def test_awkward_cells_survive_a_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [("1", 'say "hi", you'), ("2", "two\nlines, and more\n"), ("3", "back\\"), ("4", ' "" '), ("5", "  pad  "), ("6", None), ("7", "é—x")]
    W.append_batch(spark.createDataFrame(data, "id string, v string"), path)
    back = R.read_text_table(spark, path, ["id", "v"], na_tokens=False)
    assert sorted(map(tuple, back.collect())) == sorted(data)


def test_text_copy_round_trip(spark, tmp_path, sf):
    part = sf("part").select(*[F.col(c).cast("string") for c in sf("part").columns])
    W.write_text_copy(part, str(tmp_path / "p"))
    back = R.read_text_table(spark, str(tmp_path / "p"), part.columns)
    assert back.exceptAll(part).count() == 0 and back.count() == part.count()


def test_no_value_texts(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v\n1,None\n2,\n3,none\n4,NaN\n5,Null\n6,"x, y"\n')
    back = R.read_text_table(spark, str(tmp_path / "a.csv"), ["id", "v"])
    assert [r.v for r in back.orderBy("id").collect()] == [None, None, "none", None, "Null", "x, y"]
    plain = R.read_text_table(spark, str(tmp_path / "a.csv"), ["id", "v"], na_tokens=False)
    assert plain.orderBy("id").first().v == "None"


def test_append_checks_the_header_and_its_order(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1", "a")], "id string, v string")
    names = [W.append_batch(df, path), W.append_batch(df, path)]
    assert [n[:16] for n in names] == ["batch-0000000001", "batch-0000000002"]
    for wrong in (df.select("v", "id"), df.withColumn("w", F.lit("x")), df.select("id")):
        with pytest.raises(W.SchemaMismatch):
            W.append_batch(wrong, path)
    assert R.read_text_table(spark, path, ["id", "v"]).count() == 2


def test_two_writers_at_once_keep_all_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1", "a")], "id string, v string")
    # Both see the same last batch, as they would if neither had written yet.
    monkeypatch.setattr(W, "_batches", lambda *a: [])
    W.append_batch(df, path)
    W.append_batch(df, path)
    monkeypatch.undo()
    assert R.read_text_table(spark, path, ["id", "v"]).count() == 2


def test_append_of_nothing_keeps_the_header(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1", "a")], "id string, v string")
    W.append_batch(df.limit(0), path)
    assert W.header_of(spark, path) == ["id", "v"]
    W.append_batch(df, path)
    assert R.read_text_table(spark, path, ["id", "v"]).count() == 1


def test_token_replaces_its_own_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1",), ("2",)], "id string")
    W.append_batch(df, path, "run7", key="id")
    W.append_batch(df.where("id = '2'"), path, "run7", key="id")
    W.append_batch(df.where("id = '1'"), path, "run8")
    assert R.read_text_table(spark, path, ["id"]).count() == 2
    keys = {r.id for r in W.known_keys(spark, path, ["id"], "id").collect()}
    assert keys == {"1", "2"}
    assert {r.id for r in W.known_keys(spark, path, ["id"], "id", without="run8").collect()} == {"2"}


def test_rows_come_back_in_append_order(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).select(F.col("id").cast("string").alias("id"))
    W.append_batch(df.where("id >= 5").coalesce(1), path)
    W.append_batch(df.where("id < 5").repartitionByRange(2, "id").sortWithinPartitions("id"), path)
    back = R.read_text_table(spark, path, ["id"], keep_order=True).orderBy(R.ORDER)
    assert [r.id for r in back.collect()] == list("5678901234")


def test_missing_inputs(spark, tmp_path):
    with pytest.raises(R.MissingInput):
        R.required(R.read_parquet, spark, str(tmp_path / "none"))
    assert R.optional(R.read_parquet, spark, str(tmp_path / "none")) is None
    assert R.optional(R.read_text_table, spark, str(tmp_path / "none"), ["id"]) is None


def test_existing_keys_reads_one_column(spark):
    keys = R.existing_keys(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"), "l_orderkey")
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan and "IsNotNull(l_orderkey)" in plan


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "a") != work_path(spark, "a")
    df = materialise(spark.range(5), "t")
    assert df.count() == 5 and shared_root(spark) in df.inputFiles()[0]


def test_work_paths_can_be_dropped(spark, tmp_path):
    path = work_path(spark, "gone")
    spark.range(3).write.parquet(path)
    drop_work(spark, path)
    assert R.optional(R.read_parquet, spark, path) is None
    with pytest.raises(ValueError):
        drop_work(spark, str(tmp_path))


def test_published_tables(spark, sf):
    W.publish(sf("nation"), "a_view")
    W.publish(sf("nation"), "a_table", permanent=True)
    both = spark.sql("SELECT count(*) c FROM a_view JOIN a_table USING (n_nationkey)").first().c
    assert both == 25
    spark.sql("DROP TABLE a_table")
