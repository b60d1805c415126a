"""Checks of vocabulary, weights, recommendation, classification and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import metrics as M
from lakeloom.operators import sentiment as S
from lakeloom.operators import tfidf as T
from lakeloom.operators.recommend import ItemIndex, resolve_items
from lakeloom.suite.common import SQL_SPACE, STOP_WORDS, sql_strip, sql_vocabulary, table

TOP_K = 10

SQL_VOCABULARY = sql_vocabulary(2, 20_000)

SQL_WEIGHTS = f"""{SQL_VOCABULARY},
x AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS x FROM p JOIN v USING (term)),
n AS (SELECT doc_id, sqrt(sum(x * x)) AS norm FROM x GROUP BY 1),
wt AS (SELECT doc_id, term, x / norm AS weight FROM x JOIN n USING (doc_id))"""


def vocabulary(spark, sf):
    vocab = T.vocabulary(table(spark, sf, "documents"), "text", STOP_WORDS)
    return vocab.select("term", F.col("index").cast("bigint").alias("index"), "df", "cf", F.round("idf", 6).alias("idf"))


VOCABULARY = f"WITH {SQL_VOCABULARY} SELECT term, index, df, cf, round(idf, 6) AS idf FROM v"


def tfidf_weights(spark, sf):
    weights = T.weights(table(spark, sf, "documents"), "doc_id", "text", STOP_WORDS)
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


TFIDF_WEIGHTS = f"WITH {SQL_WEIGHTS} SELECT doc_id, term, round(weight, 6) AS weight FROM wt"


def resolve_item(spark, sf):
    part = table(spark, sf, "part")
    nation, name = F.col("s_nationkey"), F.col("p_name")
    query = (F.when(nation < 8, F.col("s_suppkey").cast("string"))
             .when(nation < 14, F.concat(F.lit("  "), F.upper(name), F.lit(" ")))
             .when(nation < 20, F.upper(F.substring(name, 3, 6)))
             .when(nation < 22, F.substring(name, 2, 2))
             .when(nation < 23, F.lit(" ")).otherwise(F.col("s_name")))
    queries = table(spark, sf, "supplier").join(part, F.col("s_suppkey") == F.col("p_partkey")).select(
        F.col("s_suppkey").alias("query_id"), query.alias("query"))
    return resolve_items(queries, part.select("p_partkey", "p_name", (F.col("p_partkey") + 7).alias("item_id")),
                         "p_partkey", "item_id", "p_name")


RESOLVE_ITEM = """
WITH q AS (SELECT s_suppkey AS query_id, CASE WHEN s_nationkey < 8 THEN s_suppkey::VARCHAR
    WHEN s_nationkey < 14 THEN '  ' || upper(p_name) || ' ' WHEN s_nationkey < 20 THEN upper(substr(p_name, 3, 6))
    WHEN s_nationkey < 22 THEN substr(p_name, 2, 2) WHEN s_nationkey < 23 THEN ' ' ELSE s_name END AS query
  FROM supplier JOIN part ON s_suppkey = p_partkey),
n AS (SELECT query_id, trim(lower(query)) AS text FROM q WHERE NOT regexp_full_match(query, '[0-9]+')),
t AS (SELECT p_name AS title, min(p_partkey) AS first, max(p_partkey) AS last FROM part GROUP BY 1),
exact AS (SELECT query_id, last AS row FROM n JOIN t ON text = title),
inside AS (SELECT query_id, arg_min(last, first) AS row FROM n JOIN t ON contains(title, text)
  WHERE query_id NOT IN (SELECT query_id FROM exact) GROUP BY 1)
SELECT query_id, p_partkey AS row FROM q JOIN part ON p_partkey + 7 = try_cast(query AS BIGINT)
  WHERE regexp_full_match(query, '[0-9]+')
UNION ALL SELECT * FROM exact UNION ALL SELECT * FROM inside"""


def item_index(spark, sf, path=None):
    """An index over all documents, rated by their labels."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    items = docs.select("doc_id", "text", "lang", F.col("n_chars"), (F.coalesce("quality", F.lit(0)) * 8.5).alias("rating"),
                        (F.col("n_chars") / 40.0).alias("popularity"))
    return ItemIndex.build(items, text="text", item="doc_id", title=None, row="doc_id", rating="rating",
                           popularity="popularity", columns=["lang", "rating"], stop_words=STOP_WORDS, path=path)


def item_queries(spark, sf):
    """One request per nation, for the document whose id is the nation key."""
    nation = table(spark, sf, "nation")
    return nation.select(F.col("n_nationkey").cast("bigint").alias("query_id"), F.col("n_nationkey").cast("string").alias("query"))


ANSWER = {"doc_id": "doc_id", "lang": "lang", "rating": "rating"}


def recommend_topk(spark, sf):
    return item_index(spark, sf).recommend(item_queries(spark, sf), TOP_K, answer=ANSWER)


def recommend_topk_plain(spark, sf):
    return item_index(spark, sf).recommend(item_queries(spark, sf), TOP_K, quality_boost=False, answer=ANSWER)


def _recommend_sql(final: str) -> str:
    return f"""
WITH {SQL_WEIGHTS},
q AS (SELECT n_nationkey::BIGINT AS query_id, doc_id AS own FROM nation JOIN documents ON doc_id = n_nationkey),
sims AS (SELECT query_id, b.doc_id, sum(a.weight * b.weight) AS sim
  FROM q JOIN wt a ON a.doc_id = own JOIN wt b ON b.term = a.term GROUP BY 1, 2),
everything AS (SELECT query_id, d.doc_id, lang, coalesce(quality, 0) * 8.5 AS rating, n_chars / 40.0 AS popularity,
    CASE WHEN d.doc_id = own THEN -1.0 ELSE coalesce(sim, 0.0) END AS sim
  FROM q CROSS JOIN documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN sims s USING (query_id) WHERE s.doc_id = d.doc_id
  UNION ALL
  SELECT query_id, d.doc_id, lang, coalesce(quality, 0) * 8.5, n_chars / 40.0, CASE WHEN d.doc_id = own THEN -1.0 ELSE 0.0 END
  FROM q CROSS JOIN documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
  WHERE NOT EXISTS (SELECT 1 FROM sims s WHERE s.query_id = q.query_id AND s.doc_id = d.doc_id)),
f AS (SELECT *, {final} AS final FROM everything),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(final, 9) DESC, doc_id) AS rank FROM f)
SELECT query_id, rank, doc_id, lang, rating::DOUBLE AS rating, round_even(sim, 4)::DOUBLE AS similarity_score,
  round_even(final, 4)::DOUBLE AS final_score
FROM r WHERE rank <= {TOP_K}"""


RECOMMEND_TOPK = _recommend_sql("sim * 0.80 + greatest(least(rating / 10.0, 1.0), 0.0) * 0.15 "
                                "+ greatest(least(popularity / 100.0, 1.0), 0.0) * 0.05")
RECOMMEND_TOPK_PLAIN = _recommend_sql("sim")


def stratified_split(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return S.stratified_split(labels, "doc_id", "quality")


STRATIFIED_SPLIT = """
WITH c AS (SELECT quality, count(*) AS rows, sum(count(*)) OVER () AS n FROM labels GROUP BY 1),
t AS (SELECT *, n - ceil(n * 2 / 10) AS train FROM c),
b AS (SELECT *, floor(train * rows / n) AS base, train * rows / n - floor(train * rows / n) AS rest FROM t),
k AS (SELECT quality, rows - (base + CASE WHEN row_number() OVER (ORDER BY round(rest, 9) DESC, quality)
  <= train - sum(base) OVER () THEN 1 ELSE 0 END) AS test FROM b),
h AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '-42')) AS rn FROM labels)
SELECT doc_id, quality, rn <= test AS is_test FROM h JOIN k USING (quality)"""


def balanced_weights(spark, sf):
    weights = S.balanced_weights(table(spark, sf, "labels"), "quality")
    return weights.select("quality", "rows", F.round("weight", 6).alias("weight"))


BALANCED_WEIGHTS = """
SELECT quality, count(*) AS rows, round((SELECT count(*) FROM labels)
  / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight
FROM labels GROUP BY 1"""


def class_distribution(spark, sf):
    shares = M.class_distribution(table(spark, sf, "labels"), "quality")
    return shares.select("quality", "rows", F.round("percent", 4).alias("percent"))


CLASS_DISTRIBUTION = """
SELECT quality, count(*) AS rows, round(count(*) * 100.0 / (SELECT count(*) FROM labels), 4)::DOUBLE AS percent
FROM labels GROUP BY 1"""


def _scored(spark, sf):
    """Labelled documents with a score that grows with their length."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return docs.select("quality", (F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("score"),
                       (F.col("n_chars") >= 700).cast("int").alias("prediction"))


def confusion_metrics(spark, sf):
    return M.classification_metrics(M.confusion(_scored(spark, sf), "quality", "prediction"))


CONFUSION_METRICS = """
WITH s AS (SELECT quality AS y, CASE WHEN n_chars >= 700 THEN 1 ELSE 0 END AS p FROM documents JOIN labels USING (doc_id)),
c AS (SELECT count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp,
  count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 1 AND p = 1) AS tp FROM s),
m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS pp, coalesce(tp / nullif(tp + fn, 0), 0) AS pr,
  coalesce(tn / nullif(tn + fn, 0), 0) AS np, coalesce(tn / nullif(tn + fp, 0), 0) AS nr,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS pf, coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) AS nf FROM c)
SELECT tn, fp, fn, tp, round((tp + tn) / (tn + fp + fn + tp), 4) AS accuracy, round((pr + nr) / 2, 4) AS balanced_accuracy,
  round((pf + nf) / 2, 4) AS macro_f1, round((pf * (tp + fn) + nf * (tn + fp)) / (tn + fp + fn + tp), 4) AS weighted_f1,
  round(pp, 4) AS positive_precision, round(pr, 4) AS positive_recall, round(pf, 4) AS positive_f1,
  round(np, 4) AS negative_precision, round(nr, 4) AS negative_recall, round(nf, 4) AS negative_f1 FROM m"""


def roc_auc(spark, sf):
    return M.roc_auc(_scored(spark, sf), "quality", "score").select(F.round("roc_auc", 6).alias("roc_auc"))


ROC_AUC = """
WITH s AS (SELECT quality AS y, n_chars AS s FROM documents JOIN labels USING (doc_id)),
g AS (SELECT s, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM s GROUP BY 1),
a AS (SELECT *, coalesce(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM g)
SELECT round(sum(neg * (above + pos / 2.0))::DOUBLE / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 6) AS roc_auc FROM a"""


def _reviews(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")


#: Largest gradient of a coefficient, and of the intercept per row, at which a fit counts as solved.
OPTIMUM, BALANCE = 1e-2, 1e-3


def sentiment_fit_score(spark, sf):
    """Sizes of the report, the cells of its matrix added up per class, and whether the fit is at its optimum."""
    model, report = S.train_and_evaluate(_reviews(spark, sf), key="doc_id", text="text", label="quality", stop_words=STOP_WORDS)
    proof = model.certificate()
    solved = (F.greatest("largest_gradient", "gap") <= OPTIMUM) & (F.col("intercept_gradient") <= BALANCE * F.col("rows"))
    chance = F.col("balanced_accuracy") >= 0.5
    return report.select(
        "total_rows", "train_rows", "test_rows", (F.col("tn") + F.col("fp")).alias("test_negatives"),
        (F.col("fn") + F.col("tp")).alias("test_positives"), proof.agg(F.max("rows")).scalar().alias("fitted_rows"),
        proof.agg(F.bool_and(solved)).scalar().alias("solved"), chance.alias("beats_chance"))


SENTIMENT_FIT_SCORE = f"""
WITH u AS (SELECT doc_id, quality FROM documents JOIN labels USING (doc_id)
  WHERE len(list_filter(regexp_split_to_array({sql_strip('text')}, '{SQL_SPACE}+'), lambda w: w <> '')) >= 10),
c AS (SELECT quality, count(*) AS rows, sum(count(*)) OVER () AS n FROM u GROUP BY 1),
t AS (SELECT *, n - ceil(n * 2 / 10) AS train FROM c),
b AS (SELECT *, floor(train * rows / n) AS base, train * rows / n - floor(train * rows / n) AS rest FROM t),
k AS (SELECT quality, n, train, rows - (base + CASE WHEN row_number() OVER (ORDER BY round(rest, 9) DESC, quality)
  <= train - sum(base) OVER () THEN 1 ELSE 0 END) AS test FROM b)
SELECT max(n)::BIGINT AS total_rows, max(train)::BIGINT AS train_rows, sum(test)::BIGINT AS test_rows,
  coalesce(sum(test) FILTER (quality = 0), 0)::BIGINT AS test_negatives, coalesce(sum(test) FILTER (quality = 1), 0)::BIGINT AS test_positives,
  max(train)::BIGINT AS fitted_rows, true AS solved, true AS beats_chance FROM k"""


CASES = {
    "vocabulary": (vocabulary, VOCABULARY),
    "tfidf_weights": (tfidf_weights, TFIDF_WEIGHTS),
    "resolve_item": (resolve_item, RESOLVE_ITEM),
    "recommend_topk": (recommend_topk, RECOMMEND_TOPK),
    "recommend_topk_plain": (recommend_topk_plain, RECOMMEND_TOPK_PLAIN),
    "stratified_split": (stratified_split, STRATIFIED_SPLIT),
    "balanced_weights": (balanced_weights, BALANCED_WEIGHTS),
    "class_distribution": (class_distribution, CLASS_DISTRIBUTION),
    "confusion_metrics": (confusion_metrics, CONFUSION_METRICS),
    "roc_auc": (roc_auc, ROC_AUC),
    "sentiment_fit_score": (sentiment_fit_score, SENTIMENT_FIT_SCORE),
}
