"""Checks of sources, sinks, audits, streams and whole flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import quality as Q
from lakeloom.operators import sentiment as S
from lakeloom.operators.recommend import ItemIndex
from lakeloom.operators.sentiment import MAX_TERMS, MIN_DF
from lakeloom.operators.tfidf import vocabulary
from lakeloom.operators.shaping import landing_rejects as landing_reject_counts
from lakeloom.operators.shaping import metadata_rows
from lakeloom.plans import medallion as L
from lakeloom.session import work_path
from lakeloom.sources import readers as R
from lakeloom.sources import writers as W
from lakeloom.sources.schemas import BRONZE, LANDING, text_schema
from lakeloom.streaming import ingest as I
from lakeloom.streaming.scoring import score_stream
from lakeloom.suite.common import STOP_WORDS, sql_strip, sql_terms, sql_vocabulary, sql_words, table, table_stream

TABLES = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_nationkey"], "supplier": ["s_suppkey"],
    "part": ["p_name", "p_brand"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"], "documents": ["text"], "embeddings": ["vec_id"], "pages": ["url"],
    "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}
LAYERS = {"raw": ["events", "pages", "conversations"], "clean": ["documents", "labels", "benchmark", "embeddings"],
          "marts": ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]}


def audit_tables(spark, sf):
    profiles = Q.union_all([Q.table_profile(table(spark, sf, n), n) for n in TABLES])
    return Q.null_rates(profiles).join(profiles.select("table_name", "row_count", "col_count"), "table_name")


AUDIT_TABLES = "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, "
    f"count(*) FILTER ({c} IS NULL) / count(*) AS null_rate, count(*) AS row_count, {len(cs)}::BIGINT AS col_count FROM {n}"
    for n, cs in TABLES.items() for c in cs)


def audit_keys(spark, sf):
    return Q.union_all([Q.key_profile(table(spark, sf, n), n, k) for n, k in KEYS.items()])


AUDIT_KEYS = "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, sum(c)::BIGINT AS row_count, count(*) AS distinct_keys, (sum(c) - count(*))::BIGINT AS duplicate_rows, "
    f"coalesce(sum(c) FILTER ({' OR '.join(x + ' IS NULL' for x in k)}), 0)::BIGINT AS null_keys "
    f"FROM (SELECT {', '.join(k)}, count(*) AS c FROM {n} GROUP BY ALL)" for n, k in KEYS.items())


def layer_manifest(spark, sf):
    profiles = Q.union_all([Q.table_profile(table(spark, sf, n), n, layer) for layer, names in LAYERS.items() for n in names])
    return Q.layer_totals(profiles)


LAYER_MANIFEST = ("SELECT layer, count(*) AS total_tables, sum(n)::BIGINT AS total_rows, 'SUCCESS' AS status FROM ("
                  + " UNION ALL ".join(f"SELECT '{layer}' AS layer, count(*) AS n FROM {t}" for layer, ts in LAYERS.items() for t in ts)
                  + ") GROUP BY 1")


def removed_counts(spark, sf):
    docs = table(spark, sf, "documents")
    return Q.duplicate_rows(docs, ["text"], "duplicate text").unionByName(
        Q.removed_rows(docs, S.usable_reviews(docs, "text"), "short text"))


REMOVED_COUNTS = f"""
SELECT 'duplicate text' AS step, count(*) AS rows_before, count(DISTINCT text) AS rows_after, count(*) - count(DISTINCT text) AS rows_removed FROM documents
UNION ALL SELECT 'short text', count(*), count(*) FILTER (n >= 10), count(*) - count(*) FILTER (n >= 10)
FROM (SELECT len(string_split(regexp_replace({sql_strip('text')}, '\\s+', ' ', 'g'), ' ')) AS n FROM documents)"""


def gold_audit(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    soup = F.when(F.col("quality") == 0, "").when(F.col("quality") == 1, F.col("text"))
    return Q.gold_profile(docs.select("doc_id", soup.alias("soup")), "soup")


GOLD_AUDIT = """
SELECT count(*) AS row_count, 2::BIGINT AS col_count, count(*) FILTER (quality IS NULL) AS null_soup,
  count(*) FILTER (quality = 0) AS empty_soup FROM documents LEFT JOIN labels USING (doc_id)"""


def compression_ratio(spark, sf):
    """Rows, files and sizes of tables kept as text and as Parquet; files without rows count."""
    path = work_path(spark, "sizes")
    names = ["orders", "documents", "part"]
    kept, stored, rows = [], [], []
    for name in names:
        df = table(spark, sf, name)
        rows.append(Q.write_audited(df.coalesce(1), f"{path}/{name}", name, "sizes").select("table_name", "row_count"))
        # One more file, without rows.
        df.limit(0).coalesce(1).write.mode("append").parquet(f"{path}/{name}")
        W.write_text_copy(df, f"{path}/{name}_text")
        kept.append(Q.inventory_size(Q.file_inventory(spark, f"{path}/{name}_text"), name))
        stored.append(Q.inventory_size(Q.file_inventory(spark, f"{path}/{name}"), name))
    ratios = Q.compression(Q.union_all(kept), Q.union_all(stored))
    return (ratios.join(Q.union_all(stored).select("table_name", "file_count"), "table_name").join(Q.union_all(rows), "table_name")
            .select("table_name", "row_count", "file_count", (F.col("ratio") > 0).alias("smaller")))


COMPRESSION_RATIO = "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, 2::BIGINT AS file_count, true AS smaller FROM {n}" for n in ("orders", "documents", "part"))


def audit_layer_manifest(spark, sf):
    """The manifest of a layer from the counts its writes collect and one check of keys, stored and read again."""
    path = work_path(spark, "layer")
    names = ["nation", "part", "documents", "labels"]
    profiles = [Q.write_audited(table(spark, sf, n), f"{path}/{n}", n, "Silver") for n in names[:3]]
    scanned = {"labels": table(spark, sf, "labels"), "absent": None}
    manifest = Q.audit_layer(scanned, "Silver", "silver_transformation", {"labels": ["doc_id"]}, profiles=profiles)
    W.write_manifest(manifest, f"{path}/manifest")
    back = spark.read.schema(manifest.schema).json(f"{path}/manifest")
    return back.select("pipeline_name", "status", "total_tables", "total_rows", F.explode("tables").alias("t")).select(
        "pipeline_name", "status", "total_tables", "total_rows", "t.table_name", "t.row_count", "t.col_count",
        F.aggregate(F.map_values(F.from_json("t.null_counts", "map<string,bigint>")), F.lit(0).cast("bigint"), lambda a, n: a + n).alias("nulls"),
        (F.col("t.size_kb") > 0).alias("sized"), "t.distinct_keys", "t.duplicate_rows")


def _audit_layer_sql() -> str:
    one = "\nUNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, {len(TABLES[n])}::BIGINT AS col_count, "
        f"({' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in TABLES[n])})::BIGINT AS nulls, "
        + ("count(DISTINCT doc_id) AS distinct_keys, count(*) - count(DISTINCT doc_id)" if n == "labels" else "NULL::BIGINT AS distinct_keys, NULL::BIGINT")
        + f" AS duplicate_rows FROM {n}" for n in ("nation", "part", "documents", "labels"))
    return (f"WITH t AS ({one}) SELECT 'silver_transformation' AS pipeline_name, 'SUCCESS' AS status, 4::BIGINT AS total_tables, "
            "(SELECT sum(row_count) FROM t)::BIGINT AS total_rows, *, true AS sized FROM t")


def audit_gold_manifest(spark, sf):
    """The Gold manifest with the smoke test of a recommender, stored and read again."""
    path = work_path(spark, "gold-audit")
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("title"), F.col("text").alias("metadata_soup"),
        (F.col("n_chars") % 10).cast("double").alias("vote_average"), (F.col("n_chars") % 100).cast("double").alias("popularity"))
    index = ItemIndex.build(docs, columns=["title"], stop_words=STOP_WORDS, path=f"{path}/index", row="id", max_terms=2000)
    manifest = Q.audit_gold(docs, recommender=index)
    W.write_manifest(manifest, f"{path}/manifest")
    return spark.read.schema(manifest.schema).json(f"{path}/manifest").select(
        "row_count", "col_count", "null_soup", "empty_soup", "status", "recommender_status", "recommender_test",
        "sentiment_status", "sentiment_test")


AUDIT_GOLD_MANIFEST = """
SELECT count(*) AS row_count, 5::BIGINT AS col_count, count(*) FILTER (text IS NULL) AS null_soup, count(*) FILTER (text = '') AS empty_soup,
  'SUCCESS' AS status, 'READY' AS recommender_status, 'PASSED' AS recommender_test, 'NOT_TRAINED' AS sentiment_status,
  'SKIPPED' AS sentiment_test FROM documents"""


def schema_checked_append(spark, sf):
    path = work_path(spark, "append")
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", F.col("n_chars").cast("string").alias("n_chars"))
    W.append_batch(docs.where("lang = 'en'"), path)
    W.append_batch(docs.where("lang is distinct from 'en'"), path)
    back = R.read_text_table(spark, path, docs.columns, na_tokens=False)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.col("n_chars").cast("bigint").alias("n_chars"),
                       F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


SCHEMA_CHECKED_APPEND = """
SELECT doc_id, lang, n_chars, md5(coalesce(text, '')) AS text_md5 FROM documents"""


def _landing_documents(spark, sf, where):
    """Documents in the shape of landed detail records."""
    docs = table(spark, sf, "documents").where(where)
    genre = F.struct(F.col("doc_id").alias("id"), F.col("lang").alias("name"), F.array(F.col("source")).alias("seen"))
    known = {"id": F.col("doc_id"), "title": F.col("source"), "overview": F.col("text"), "media_type": F.lit("movie"),
             "vote_count": F.col("n_chars"), "original_language": F.col("lang"), "genres": F.array(genre)}
    return docs.select(*[known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in LANDING.fields])


def nested_landing_source(spark, sf):
    path = work_path(spark, "landing")
    _landing_documents(spark, sf, "true").write.json(path)
    rows = metadata_rows(R.read_landing(spark, path))
    return rows.select("id", "title", F.md5("overview").alias("overview_md5"), "genres", "vote_count", "imdb_id")


NESTED_LANDING_SOURCE = """
SELECT doc_id::VARCHAR AS id, source AS title, md5(text) AS overview_md5, '[{"id":' || doc_id || ',"name":"' || lang || '","seen":["' || source || '"]}]' AS genres,
  n_chars::VARCHAR AS vote_count, 'tt' || doc_id AS imdb_id FROM documents"""


def landing_rejects(spark, sf):
    path = work_path(spark, "landing")
    rows = F.to_json(F.struct(F.col("doc_id").alias("id"), F.when(F.col("n_chars") % 3 != 0, F.col("source")).alias("title")))
    broken = F.when(F.col("lang") == "de", F.concat(F.lit("{"), rows)).when(
        F.col("lang") == "fr", F.replace(rows, F.lit('"id"'), F.lit('"key"'))).otherwise(rows)
    table(spark, sf, "documents").select(broken.alias("value")).write.text(path)
    return landing_reject_counts(R.read_landing(spark, path))


LANDING_REJECTS = """
SELECT CASE WHEN lang = 'de' THEN 'broken' WHEN lang = 'fr' THEN 'no id' WHEN n_chars % 3 = 0 THEN 'no title' ELSE 'landed' END AS reason,
  count(*) AS records FROM documents GROUP BY 1"""


def micro_ingest_stream(spark, sf):
    path = work_path(spark, "ingest")
    _landing_documents(spark, sf, "lang <> 'en'").write.json(f"{path}/landing")

    def run():
        I.micro_ingest(spark, f"{path}/landing", f"{path}/bronze", f"{path}/checkpoint").awaitTermination()

    run()
    # The second drop repeats the first one.
    _landing_documents(spark, sf, "true").write.mode("append").json(f"{path}/landing")
    run()
    run()
    back = R.read_text_table(spark, f"{path}/bronze/movies_metadata", BRONZE["movies_metadata"], na_tokens=False)
    return back.select(F.col("id").cast("bigint").alias("id"), "title", "vote_count", "original_language")


MICRO_INGEST_STREAM = """
SELECT doc_id AS id, source AS title, n_chars::VARCHAR AS vote_count, lang AS original_language FROM documents"""


def cross_run_dedup(spark, sf):
    path = work_path(spark, "runs")
    events = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("event_id"), "event_type")
    I.append_new(events.where("event_type in ('click', 'view')"), path, "event_id", "first")
    I.append_new(events, path, "event_id", "second")
    I.append_new(events, path, "event_id", "second")
    back = R.read_text_table(spark, path, ["event_id", "event_type"], keep_order=True)
    run = F.regexp_extract("_order.folder", "batch-0*([0-9]+)-", 1).cast("bigint")
    return back.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", run.alias("run"))


CROSS_RUN_DEDUP = """
SELECT event_id, event_type, CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 2 END::BIGINT AS run FROM events"""


def many_runs_dedup(spark, sf, batches=12):
    """Many small batches, each overlapping the one before it, against the ledger's runs; the fifth is replayed at once."""
    path = work_path(spark, "many-runs")
    events = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("event_id"), "event_type")
    slot = F.pmod(F.col("event_id").cast("bigint"), F.lit(batches))
    for n in range(batches):
        part = events.where((slot == n) | (slot == max(n - 1, 0)))
        for _ in range(2 if n == 4 else 1):
            I.append_new(part, path, "event_id", f"run{n}")
    back = R.read_text_table(spark, path, ["event_id", "event_type"], keep_order=True)
    run = F.regexp_extract("_order.folder", "batch-0*([0-9]+)-", 1).cast("bigint")
    return back.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", run.alias("run"))


MANY_RUNS_DEDUP = "SELECT event_id, event_type, (event_id % 12 + 1)::BIGINT AS run FROM events"


def stream_late_settled(spark, sf):
    """Batches in which old events come late, some new and some repeated; a watermark alone would lose the new ones."""
    path = work_path(spark, "settled")
    events = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("ts").cast("string").alias("ts"), "event_type")
    number = F.col("event_id").cast("bigint")
    old = F.pmod(number, F.lit(7)) == 3
    parts = [events.where(~old & (F.pmod(number, F.lit(2)) == 0)), events.where(~old), events]
    for n, part in enumerate(parts):
        I.append_settled(part, path, "event_id", "ts", "1 HOUR", f"batch{n}")
    I.append_settled(parts[-1], path, "event_id", "ts", "1 HOUR", "batch2")
    counts = I.late_counts(spark, path)
    back = R.read_text_table(spark, path, ["event_id", "ts", "event_type"], keep_order=True)
    run = F.regexp_extract("_order.folder", "batch-0*([0-9]+)-", 1).cast("bigint")
    return back.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", run.alias("run"),
                       F.lit(counts.late > counts.settled > 0).alias("late_ones_settled"))


STREAM_LATE_SETTLED = """
SELECT event_id, event_type, CASE WHEN event_id % 7 = 3 THEN 3 WHEN event_id % 2 = 0 THEN 1 ELSE 2 END::BIGINT AS run,
  true AS late_ones_settled FROM events"""


def stream_dedup_watermark(spark, sf):
    path = work_path(spark, "dedup")
    twice = table_stream(spark, sf, "events").select("event_id", "ts", "event_type", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    once = I.dedup_stream(twice, ["event_id"], "ts", "1 hour").select("event_id", "event_type")
    (once.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
     .start(f"{path}/out", format="parquet", outputMode="append").awaitTermination())
    return spark.read.parquet(f"{path}/out")


STREAM_DEDUP_WATERMARK = "SELECT event_id, event_type FROM events"


def _fixed_model(spark, sf, path):
    """A linear model over the vocabulary of the documents whose coefficients follow from the counts."""
    terms = vocabulary(table(spark, sf, "documents"), "text", STOP_WORDS, MIN_DF, MAX_TERMS)
    W.write_parquet(terms.withColumn("coefficient", F.col("cf") / F.col("df") - 1.3), f"{path}/terms")
    return S.SentimentModel(R.read_parquet(spark, f"{path}/terms"), 0.05, STOP_WORDS, MAX_TERMS, path)


def stream_score(spark, sf):
    path = work_path(spark, "score")
    turns = table_stream(spark, sf, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("turn_id"), "role", "text")
    model = _fixed_model(spark, sf, path)
    score_stream(turns, model, "turn_id", "text", f"{path}/out", f"{path}/checkpoint", keep=["role"]).awaitTermination()
    return spark.read.parquet(f"{path}/out").select(
        "turn_id", "role", "label", "prediction", F.round("probability", 5).alias("probability"),
        F.round("confidence", 5).alias("confidence"))


STREAM_SCORE = f"""
WITH {sql_vocabulary(MIN_DF, MAX_TERMS)},
c AS (SELECT conv_id || '-' || turn AS turn_id, role, {sql_words('text')} AS w FROM conversations),
t AS (SELECT turn_id, term, count(*) AS tf FROM (SELECT turn_id, unnest({sql_terms('w')}) AS term FROM c) GROUP BY 1, 2),
x AS (SELECT turn_id, (1 + ln(tf)) * idf AS x, cf / df - 1.3 AS coefficient FROM t JOIN v USING (term)),
d AS (SELECT turn_id, sum(x * coefficient) / sqrt(sum(x * x)) AS dot FROM x GROUP BY 1),
s AS (SELECT turn_id, role, 1 / (1 + exp(-(0.05 + coalesce(dot, 0)))) AS p FROM c LEFT JOIN d USING (turn_id))
SELECT turn_id, role, CASE WHEN p > 0.5 THEN 'positive' ELSE 'negative' END AS label, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction,
  round(p, 5) AS probability, round(greatest(p, 1 - p), 5) AS confidence FROM s"""


def gold_sql_view(spark, sf):
    W.publish(table(spark, sf, "part"), "lakeloom_gold_part")
    return spark.sql("""
        SELECT p_brand, p_type, count(*) AS items, round(avg(p_retailprice), 4) AS average_price, max(p_size) AS largest
        FROM lakeloom_gold_part WHERE p_size > 5 GROUP BY p_brand, p_type""")


GOLD_SQL_VIEW = """
SELECT p_brand, p_type, count(*) AS items, round(avg(p_retailprice), 4) AS average_price, max(p_size) AS largest
FROM part WHERE p_size > 5 GROUP BY 1, 2"""


def silver_reviews_flow(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    rating = F.when(F.col("quality") == 1, "8.5").when(F.col("toxic") == 1, "bad").when(F.col("quality") == 0, " 5.99 ")
    bronze = docs.select(F.md5("text").alias("review_id"), F.col("doc_id").cast("string").alias("movieId"),
                         F.col("source").alias("movie_title"), F.col("text").alias("review_text"),
                         F.lit("").alias("sentiment"), rating.alias("rating"), F.col("doc_id").alias(R.ORDER))
    out = L.silver_reviews(bronze)
    return out.withColumn("review_text", F.md5("review_text"))


SILVER_REVIEWS_FLOW = f"""
WITH d AS (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents LEFT JOIN labels USING (doc_id)),
f AS (SELECT md5(text) AS review_id, doc_id AS "movieId", source AS movie_title, {sql_strip('text')} AS body, '' AS sentiment,
  (CASE WHEN quality = 1 THEN 8.5 WHEN toxic = 1 THEN 7.0 WHEN quality = 0 THEN 5.99 ELSE 7.0 END)::DOUBLE AS rating FROM d WHERE rn = 1)
SELECT review_id, "movieId", movie_title, md5(body) AS review_text, sentiment, rating,
  CASE WHEN rating >= 6 THEN 'positive' ELSE 'negative' END AS sentiment_label FROM f WHERE length(body) > 20"""


def _bronze_parts(spark, sf):
    """Parts as raw text tables: movies, credits and keywords, with repeats and gaps."""
    part = table(spark, sf, "part")
    key = F.col("p_partkey").cast("string")

    def listed(*columns):
        return F.to_json(F.array(*[F.struct(F.col(c).alias("name")) for c in columns]))

    words = F.split("p_name", " ")
    movies = part.select(
        key.alias("id"), F.when(F.col("p_type") != "PROMO", F.col("p_name")).alias("title"), F.col("p_name").alias("original_title"),
        F.concat(F.lit("  The  "), "p_name", F.lit("\n")).alias("overview"), listed("p_type", "p_brand").alias("genres"),
        F.lit("x").alias("budget"), F.lit(None).cast("string").alias("revenue"),
        F.concat(F.lit(1960) + F.col("p_size"), F.lit("-1-31")).alias("release_date"),
        F.concat("p_size", F.lit(".9")).alias("runtime"), F.col("p_size").cast("string").alias("popularity"),
        F.lit("1e1").alias("vote_average"), key.alias("vote_count"), F.lit("/p").alias("poster_path"), F.lit("tt").alias("imdb_id"),
        F.when(F.col("p_size") > 25, " CN").alias("original_language"), F.lit("").alias("status"), F.lit("").alias("tagline"),
        F.lit("movie").alias("media_type"), listed("p_brand").alias("production_companies"), F.lit("[]").alias("production_countries"),
        F.lit("no json").alias("spoken_languages"), F.col("p_partkey").alias(R.ORDER))
    movies = movies.unionByName(movies.withColumn(R.ORDER, F.col(R.ORDER) + 10**12).withColumn("title", F.lit("again")))
    crew = F.to_json(F.array(*[F.struct(n.alias("name"), j.alias("job")) for n, j in (
        (words[0], F.lit("Director")), (words[1], F.lit("Producer")), (words[0], F.lit("Writer")), (F.col("p_type"), F.lit("Editor")))]))
    credits = part.where("p_size <= 40").select(key.alias("id"), listed("p_brand").alias("cast"), crew.alias("crew"), F.col("p_partkey").alias(R.ORDER))
    keywords = part.where("p_size > 10").select(key.alias("id"), listed("p_type").alias("keywords"), F.col("p_partkey").alias(R.ORDER))
    return movies, credits, keywords


def gold_features_flow(spark, sf):
    movies, credits, keywords = _bronze_parts(spark, sf)
    return L.gold_features(L.silver_movies(movies), L.silver_credits(credits), L.silver_keywords(keywords))


GOLD_FEATURES_FLOW = """
WITH b AS (SELECT *, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2, 'the ' || p_name AS overview,
  lower(p_type) || ', ' || lower(p_brand) AS genres, lower(p_brand) AS brand,
  CASE WHEN p_size > 10 THEN lower(p_type) ELSE '' END AS kw, p_size <= 40 AS c FROM part)
SELECT p_partkey AS id, CASE WHEN p_type <> 'PROMO' THEN p_name ELSE 'Unknown Title' END AS title, p_name AS original_title, overview,
  (1960 + p_size)::VARCHAR || '-01-31' AS release_date, p_size::BIGINT AS runtime, p_size::DOUBLE AS popularity, 10.0::DOUBLE AS vote_average,
  p_partkey AS vote_count, CASE WHEN p_size > 25 THEN 'zh' ELSE 'en' END AS original_language, '/p' AS poster_path, genres AS genres_clean,
  p_brand AS production_companies_clean, '' AS production_countries_clean,
  CASE WHEN c THEN brand ELSE '' END AS top_cast_clean, CASE WHEN c THEN w1 ELSE '' END AS director_clean,
  CASE WHEN c THEN w2 || ', ' || w1 ELSE '' END AS writers_producers_clean,
  CASE WHEN c THEN w1 || ', ' || w2 || ', ' || w1 || ', ' || p_type END AS all_crew_clean, kw AS keywords_clean,
  (1960 + p_size)::BIGINT AS release_year,
  trim(overview || ' ' || genres || ' ' || genres || CASE WHEN kw <> '' THEN ' ' || kw || ' ' || kw ELSE '' END
    || CASE WHEN c THEN ' ' || w1 || ' ' || w1 || ' ' || w1 || ' ' || brand || ' ' || w2 || ', ' || w1 ELSE '' END) AS metadata_soup
FROM b"""

CASES = {
    "audit_tables": (audit_tables, AUDIT_TABLES),
    "audit_keys": (audit_keys, AUDIT_KEYS),
    "layer_manifest": (layer_manifest, LAYER_MANIFEST),
    "removed_counts": (removed_counts, REMOVED_COUNTS),
    "gold_audit": (gold_audit, GOLD_AUDIT),
    "compression_ratio": (compression_ratio, COMPRESSION_RATIO),
    "audit_layer_manifest": (audit_layer_manifest, _audit_layer_sql()),
    "audit_gold_manifest": (audit_gold_manifest, AUDIT_GOLD_MANIFEST),
    "schema_checked_append": (schema_checked_append, SCHEMA_CHECKED_APPEND),
    "nested_landing_source": (nested_landing_source, NESTED_LANDING_SOURCE),
    "landing_rejects": (landing_rejects, LANDING_REJECTS),
    "micro_ingest_stream": (micro_ingest_stream, MICRO_INGEST_STREAM),
    "cross_run_dedup": (cross_run_dedup, CROSS_RUN_DEDUP),
    "many_runs_dedup": (many_runs_dedup, MANY_RUNS_DEDUP),
    "stream_late_settled": (stream_late_settled, STREAM_LATE_SETTLED),
    "stream_dedup_watermark": (stream_dedup_watermark, STREAM_DEDUP_WATERMARK),
    "stream_score": (stream_score, STREAM_SCORE),
    "gold_sql_view": (gold_sql_view, GOLD_SQL_VIEW),
    "silver_reviews_flow": (silver_reviews_flow, SILVER_REVIEWS_FLOW),
    "gold_features_flow": (gold_features_flow, GOLD_FEATURES_FLOW),
}
