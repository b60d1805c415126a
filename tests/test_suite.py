import pytest
from oracle import connect, differences

from lakeloom.suite import CASES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, (_, sql) in CASES.items() if sql])
def test_query_equals_its_sql(spark, con, name):
    run, sql = CASES[name]
    assert differences(run(spark, SF), con, sql) == []


@pytest.mark.parametrize("name", [n for n, (_, sql) in CASES.items() if not sql])
def test_query_without_sql_gives_rows(spark, name):
    assert CASES[name][0](spark, SF).count() > 0


def test_contract():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_streams_read_tables_kept_as_folders(spark, tmp_path):
    turns = spark.createDataFrame([(c, t, "user", f"alpha beta word{c}") for c in range(6) for t in range(2)],
                                  "conv_id long, turn int, role string, text string")
    events = spark.range(20).selectExpr("id AS event_id", "timestamp_seconds(1000000000 + id) AS ts", "'view' AS event_type")
    docs = spark.range(5).selectExpr("id AS doc_id", "'alpha beta gamma' AS text")
    for name, df in (("conversations", turns), ("events", events), ("documents", docs)):
        df.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    assert sorted(r.turn_id for r in CASES["stream_score"][0](spark, str(tmp_path)).collect()) == sorted(
        f"{c}-{t}" for c in range(6) for t in range(2))
    assert sorted(r.event_id for r in CASES["stream_dedup_watermark"][0](spark, str(tmp_path)).collect()) == list(range(20))
