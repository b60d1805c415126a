"""The physical plans are the ones the operators are written for."""

import re

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import relational as R
from lakeloom.operators import tfidf as T
from lakeloom.plans.medallion import GOLD_CREDIT_COLUMNS, GOLD_MOVIE_COLUMNS, gold_features, silver_credits
from lakeloom.suite import CASES
from lakeloom.suite.models import item_index, item_queries

SF = "/root/testdata/sf0.001"
LAZY = ["dedup_keep_first", "union_first_wins_cap", "incremental_exclude", "group_quota", "staged_acquisition",
        "left_join_features", "null_safe_left_join", "source_fallback", "coverage_argmax", "vocabulary", "tfidf_weights",
        "resolve_item", "stratified_split", "roc_auc", "audit_keys", "gold_features_flow", "recommend_topk"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins(spark, name):
    text = plan(CASES[name][0](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["json_names", "text_normalise", "tokens_ngrams", "recommend_topk", "gold_features_flow"])
def test_no_python_in_tasks(spark, name):
    text = plan(CASES[name][0](spark, SF))
    assert "Python" not in text and "Pandas" not in text


def test_scoring_shuffles_only_the_best_candidates(spark):
    index = item_index(spark, SF)
    text = plan(index.scores(index.resolve(item_queries(spark, SF)), 10))
    scoring = text[text.index("Generate explode(entries"):] if "Generate explode(entries" in text else text
    above = text[:text.index("explode(entries")]
    last = above[above.rindex("WindowGroupLimit"):]
    assert "Exchange" not in last and "HashAggregate" in last, scoring


def test_quota_is_pruned_before_the_shuffle(spark):
    text = plan(CASES["group_quota"][0](spark, SF))
    assert len(re.findall("WindowGroupLimit", text)) == 2


def test_keep_first_prunes_before_the_shuffle(spark, sf):
    text = plan(R.keep_first(sf("events"), ["user_id"], "event_id"))
    assert len(re.findall("WindowGroupLimit", text)) == 2 and len(re.findall("Exchange hash", text)) == 1


def test_large_quota_works_on_slices(spark, sf):
    events = sf("events").repartition(5)
    order = [F.desc("value"), F.asc("event_id")]
    got = R.top_per_group(events, ["event_type"], order, 150)
    monkey, R.WINDOW_PRUNE_LIMIT = R.WINDOW_PRUNE_LIMIT, 10
    try:
        sliced = R.top_per_group(events, ["event_type"], order, 150)
        assert len(re.findall("Exchange hash", plan(sliced))) == 2
        assert sorted(map(tuple, got.select("event_id", "rank").collect())) == sorted(
            map(tuple, sliced.select("event_id", "rank").collect()))
    finally:
        R.WINDOW_PRUNE_LIMIT = monkey


def test_weighing_shuffles_the_text_once_and_nothing_else(spark, sf):
    vocab = spark.createDataFrame([("a", 0, 1.0)], "term string, index int, idf double")
    text = plan(T.vectors(sf("documents"), "doc_id", "text", vocab, 10))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1 and "SortMergeJoin" not in text


def test_counting_terms_does_not_shuffle_the_text(spark, sf, monkeypatch):
    # A small input may be one file that Spark cannot cut, and is spread over the cores first.
    assert "RoundRobinPartitioning" in plan(T.term_statistics(sf("documents"), "text"))
    monkeypatch.setattr(T, "SMALL_INPUT", 0)
    assert re.findall(r"Exchange \w+", plan(T.term_statistics(sf("documents"), "text"))) == ["Exchange hashpartitioning"]


def test_filters_and_columns_reach_the_scan(spark):
    text = CASES["union_first_wins_cap"][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_type,PROMO)" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_returnflag:string>" in text


def test_vocabulary_is_sorted_only_above_the_cut(spark, sf):
    df = sf("events").groupBy(F.col("props").alias("term")).agg(F.count("*").alias("cf"))
    assert "Subquery" in plan(R.top_n_pruned(df, "cf", "term", 10))


def test_gold_shuffles_each_table_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        movies, credits, keywords = (spark.range(9).selectExpr("id", *[f"'x' AS {c}" for c in cols if c != "id"]) for cols in (
            GOLD_MOVIE_COLUMNS, GOLD_CREDIT_COLUMNS, ["keywords_clean"]))
        text = plan(gold_features(movies, credits, keywords))
        assert len(re.findall("Exchange hashpartitioning", text)) == 3 and len(re.findall("SortMergeJoin", text)) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_crew_is_parsed_once(spark):
    bronze = spark.createDataFrame([("1", "[]", "[]")], "id string, cast string, crew string")
    text = silver_credits(bronze)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"parse_?json\(crew", text, re.I)) == 1, text
