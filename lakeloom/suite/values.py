"""Checks of casts, text, JSON and record shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import cast as C
from lakeloom.functions import nested as N
from lakeloom.functions import score
from lakeloom.functions import text as X
from lakeloom.operators import shaping as R
from lakeloom.suite.common import STOP_WORDS, sql_collapse, sql_strip, sql_terms, sql_words, table


def lenient_cast(spark, sf):
    k = F.regexp_extract("props", "[0-9]+", 0)
    text = (F.when(F.col("event_type") == "click", F.concat(F.lit("-"), k, F.lit(".75")))
            .when(F.col("event_type") == "view", F.concat(F.lit(" "), k, F.lit(" ")))
            .when(F.col("event_type") == "error", F.concat(k, F.lit("d")))
            .when(F.col("event_type") == "signup", F.concat(k, F.lit("e2")))
            .otherwise(F.concat(F.lit("+."), k)))
    events = table(spark, sf, "events").select("event_id", text.alias("t"))
    return events.select("event_id", C.lenient_double("t").alias("as_double"), C.lenient_double("t", 7.0).alias("or_seven"),
                         C.lenient_int("t").alias("as_int"), C.lenient_id("t", "null").alias("as_id"))


LENIENT_CAST = """
WITH t AS (SELECT event_id, event_type AS e, regexp_extract(props, '[0-9]+') AS k FROM events),
v AS (SELECT event_id, CASE e WHEN 'click' THEN try_cast('-' || k || '.75' AS DOUBLE)
  WHEN 'view' THEN try_cast(k AS DOUBLE) WHEN 'error' THEN NULL WHEN 'signup' THEN try_cast(k || 'e2' AS DOUBLE)
  ELSE try_cast('0.' || k AS DOUBLE) END AS d FROM t)
SELECT event_id, d AS as_double, coalesce(d, 7.0) AS or_seven, coalesce(trunc(d), 0)::BIGINT AS as_int,
  CASE WHEN trunc(d) = d THEN d::BIGINT END AS as_id FROM v"""


def lenient_date(spark, sf):
    day = F.col("o_orderdate").cast("date").cast("string")
    short = F.regexp_replace(day, "-0", "-")
    text = (F.when(F.col("o_orderpriority") == "1-URGENT", day)
            .when(F.col("o_orderpriority") == "2-HIGH", short)
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.replace(day, F.lit("-"), F.lit("/")))
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(F.substring(day, 1, 8), F.lit("31")))
            .otherwise(F.concat(day, F.lit("T00:00:00"))))
    orders = table(spark, sf, "orders").select("o_orderkey", text.alias("date_text"))
    return orders.select("o_orderkey", "date_text", C.iso_date("date_text").alias("iso"),
                         C.release_year("date_text").alias("year"))


LENIENT_DATE = """
WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderpriority AS p FROM orders),
t AS (SELECT o_orderkey, CASE p WHEN '1-URGENT' THEN d WHEN '2-HIGH' THEN replace(d, '-0', '-')
  WHEN '3-MEDIUM' THEN replace(d, '-', '/') WHEN '4-NOT SPECIFIED' THEN substr(d, 1, 8) || '31'
  ELSE d || 'T00:00:00' END AS date_text FROM o),
v AS (SELECT *, CASE WHEN regexp_full_match(date_text, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
  THEN try_strptime(date_text, '%Y-%m-%d') END AS v FROM t)
SELECT o_orderkey, date_text, strftime(v, '%Y-%m-%d') AS iso, coalesce(year(v), 0)::BIGINT AS year FROM v"""


def text_normalise(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id", F.md5(X.clean("text")).alias("clean_md5"), F.md5(X.strip("text")).alias("strip_md5"),
        F.length(X.filled("text")).cast("bigint").alias("stripped_length"),
        X.language_code(F.upper("lang"), remap={"fr": "zh"}).alias("language"),
        X.longer_than("text", 2000).alias("is_long"))


TEXT_NORMALISE = f"""
WITH s AS (SELECT doc_id, lang, text, {sql_strip('text')} AS stripped FROM documents)
SELECT doc_id, md5({sql_collapse('lower(text)')}) AS clean_md5, md5(stripped) AS strip_md5,
  length(stripped) AS stripped_length, CASE WHEN lang = 'fr' THEN 'zh' ELSE lang END AS language,
  length(stripped) > 2000 AS is_long FROM s"""


def _named(words):
    return F.transform(words, lambda w: F.concat(F.lit('{"name":"'), w, F.lit('"}')))


def json_names(spark, sf):
    words = F.split("p_name", " ")
    tail = (F.when(F.col("p_type") == "ECONOMY", "]").when(F.col("p_type") == "SMALL", ',5,["a"],null]')
            .when(F.col("p_type") == "PROMO", "").when(F.col("p_type") == "LARGE", ',{"name":null},{"name":0},{"id":1}]')
            .when(F.col("p_type") == "MEDIUM", ',{"name":true}]'))
    text = F.when(F.col("p_type") == "STANDARD", _named(words)[0]).otherwise(
        F.concat(F.lit("["), F.array_join(_named(words), ","), tail))
    return table(spark, sf, "part").select("p_partkey", N.json_names(text).alias("names"))


JSON_NAMES = """
SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'LARGE') THEN replace(p_name, ' ', ', ') ELSE '' END AS names
FROM part"""


def json_names_by_role(spark, sf):
    words = F.split("p_name", " ")

    def member(name, job):
        return F.struct(name.alias("name"), job.alias("job"))

    crew = F.to_json(F.array(member(words[0], F.col("p_type")), member(words[1], F.lit("LARGE")),
                             member(words[0], F.lit("LARGE")), member(words[1], F.col("p_type"))))
    return table(spark, sf, "part").select("p_partkey", N.json_names_by_role(crew, ["PROMO", "LARGE"]).alias("names"))


JSON_NAMES_BY_ROLE = """
SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'LARGE') THEN split_part(p_name, ' ', 1) || ', ' || split_part(p_name, ' ', 2)
  ELSE split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1) END AS names FROM part"""


def json_scalar(spark, sf):
    return table(spark, sf, "events").select("event_id", N.json_scalar("props", "$.k", "bigint").alias("k"),
                                             N.json_scalar("props", "$.missing", "bigint").alias("missing"))


JSON_SCALAR = """
SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, json_extract(props, '$.missing')::BIGINT AS missing FROM events"""


def _conversation_records(spark, sf):
    """Conversations as detail records whose reviews are the turns, of which the operator takes three."""
    turns = table(spark, sf, "conversations")
    review = F.struct("turn", F.when(F.col("turn") != 1, F.concat_ws("-", "conv_id", "turn")).alias("id"),
                      F.concat(F.lit(" \n"), F.col("text"), F.lit("\r\n ")).alias("content"),
                      F.struct((F.col("turn") * 5.0).alias("rating")).alias("author_details"))
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(review)).alias("results"))
    return listed.select(F.col("conv_id").alias("id"), F.lit("").alias("title"),
                         F.concat(F.lit("talk "), "conv_id").alias("name"), F.struct("results").alias("reviews"))


def nested_slice(spark, sf):
    return R.review_rows(_conversation_records(spark, sf), longer_than=60)


NESTED_SLICE = f"""
WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn, {sql_strip('text')} AS body FROM conversations)
SELECT CASE WHEN turn <> 1 THEN conv_id || '-' || turn ELSE 'r_' || conv_id END AS review_id, conv_id::VARCHAR AS "movieId",
  'talk ' || conv_id AS movie_title, replace(replace(body, chr(10), ' '), chr(13), '') AS review_text,
  CASE WHEN turn = 1 THEN 'negative' ELSE 'positive' END AS sentiment,
  CASE WHEN turn = 0 THEN '7.0' ELSE (turn * 5.0)::DOUBLE::VARCHAR END AS rating
FROM t WHERE rn <= 3 AND length(body) > 60"""


def _customer_records(spark, sf):
    """Customers with their nation as detail records."""
    segment = F.col("c_mktsegment")
    customer = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))

    def named(*columns):
        return F.array(*[F.to_json(F.struct(c.alias("name"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("order")))
                         for c in columns])

    crew = F.array(*[F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col(n).alias("name"), j.alias("job"))) for n, j in (
        ("c_name", F.lit("Director")), ("n_name", F.lit("Editor")), ("n_name", segment), ("c_mktsegment", F.lit("Writer")))])
    cast = F.flatten(F.array_repeat(named(F.col("c_name"), F.col("n_name"), segment), 4))
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.when(segment != "BUILDING", F.col("c_name")).alias("title"), F.concat(F.lit("the "), "c_name").alias("name"),
        F.lit("").alias("original_title"), F.col("n_name").alias("original_name"),
        F.when(segment != "MACHINERY", F.col("n_name")).alias("overview"), segment.alias("poster_path"),
        F.when(segment == "HOUSEHOLD", F.concat(F.lit("tt00"), "c_custkey")).alias("imdb_id"),
        F.lit(None).cast("string").alias("original_language"),
        F.lit("").alias("release_date"), F.lit("1999-01-01").alias("first_air_date"),
        F.when(segment != "FURNITURE", F.col("c_nationkey")).alias("runtime"),
        F.when(segment == "BUILDING", F.array(F.col("c_nationkey"), F.lit(1))).alias("episode_run_time"),
        F.col("c_custkey").alias("budget"), F.lit(None).cast("bigint").alias("revenue"),
        F.col("c_acctbal").alias("popularity"), F.when(segment != "HOUSEHOLD", F.col("c_acctbal")).alias("vote_average"),
        F.col("c_custkey").alias("vote_count"), F.lit(None).cast("string").alias("status"), F.lit("x").alias("tagline"),
        F.when(segment.isin("BUILDING", "MACHINERY"), "tv").otherwise("movie").alias("media_type"),
        named(segment, F.col("n_name")).alias("genres"), F.array().cast("array<string>").alias("production_companies"),
        F.lit(None).cast("array<string>").alias("production_countries"), named(F.col("n_name")).alias("spoken_languages"),
        F.struct(cast.alias("cast"), crew.alias("crew")).alias("credits"),
        F.struct(F.when(segment == "HOUSEHOLD", named(segment)).alias("keywords"),
                 F.when(segment != "MACHINERY", named(F.col("n_name"))).alias("results")).alias("keywords"))


def shape_records(spark, sf):
    return R.metadata_rows(R.has_identity(_customer_records(spark, sf)))


SHAPE_RECORDS = """
SELECT c_custkey::VARCHAR AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name ELSE 'the ' || c_name END AS title,
  n_name AS original_title, CASE WHEN c_mktsegment <> 'MACHINERY' THEN n_name ELSE '' END AS overview,
  '[{"name":"' || c_mktsegment || o || ',{"name":"' || n_name || o || ']' AS genres,
  c_custkey::VARCHAR AS budget, '0' AS revenue, '1999-01-01' AS release_date,
  (CASE c_mktsegment WHEN 'BUILDING' THEN c_nationkey WHEN 'MACHINERY' THEN 45 WHEN 'FURNITURE' THEN 0
    ELSE c_nationkey END)::VARCHAR AS runtime,
  c_acctbal::VARCHAR AS popularity, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_acctbal::VARCHAR ELSE '0.0' END AS vote_average,
  c_custkey::VARCHAR AS vote_count, c_mktsegment AS poster_path,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'tt00' || c_custkey ELSE 'tt' || c_custkey END AS imdb_id,
  'en' AS original_language, 'Released' AS status, 'x' AS tagline,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'tv' ELSE 'movie' END AS media_type,
  '[]' AS production_companies, '[]' AS production_countries, '[{"name":"' || n_name || o || ']' AS spoken_languages
FROM (SELECT *, '","id":' || c_custkey || ',"order":' || c_nationkey || '}' AS o FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def shape_lists(spark, sf):
    records = _customer_records(spark, sf)
    return R.credit_rows(records).join(R.keyword_rows(records), "id")


SHAPE_LISTS = """
WITH o AS (SELECT *, '","id":' || c_custkey || ',"order":' || c_nationkey || '}' AS o FROM customer JOIN nation ON c_nationkey = n_nationkey),
t AS (SELECT c_custkey, c_mktsegment AS s, '{"name":"' || c_name || o AS c, '{"name":"' || n_name || o AS n,
  '{"name":"' || c_mktsegment || o AS m, c_name, n_name FROM o)
SELECT c_custkey::VARCHAR AS id, '[' || repeat(c || ',' || n || ',' || m || ',', 3) || c || ']' AS cast,
  '[{"id":' || c_custkey || ',"name":"' || c_name || '","job":"Director"},{"id":' || c_custkey || ',"name":"' || s || '","job":"Writer"}]' AS crew,
  CASE s WHEN 'HOUSEHOLD' THEN '[' || m || ']' WHEN 'MACHINERY' THEN '[]' ELSE '[' || n || ']' END AS keywords
FROM t"""


def shape_links_ratings(spark, sf):
    records = _customer_records(spark, sf)
    return R.link_rows(records).join(R.rating_rows(records), "movieId")


SHAPE_LINKS_RATINGS = """
SELECT c_custkey::VARCHAR AS "movieId", CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '00' || c_custkey ELSE '' END AS "imdbId",
  c_custkey::VARCHAR AS "tmdbId", '1' AS "userId",
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '7.0' ELSE c_acctbal::VARCHAR END AS rating, '1600000000' AS "timestamp"
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def sentiment_label(spark, sf):
    rated = table(spark, sf, "events").select(
        "event_id", F.coalesce(F.when(F.col("event_type") != "error", F.col("value") / 50), F.lit(7.0)).alias("rating"))
    return rated.select("event_id", score.sentiment_label("rating").alias("label"),
                        score.label_value(score.sentiment_label("rating")).alias("label_value"),
                        score.rounded(score.blend(F.lit(0.5), "rating", F.col("event_id")), 6).alias("blended"))


SENTIMENT_LABEL = """
WITH r AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value / 50 ELSE 7.0 END AS rating FROM events)
SELECT event_id, CASE WHEN rating >= 6.0 THEN 'positive' ELSE 'negative' END AS label,
  CASE WHEN rating >= 6.0 THEN 1 ELSE 0 END AS label_value,
  round_even(0.5 * 0.80 + greatest(least(rating / 10.0, 1.0), 0.0) * 0.15
    + greatest(least(event_id / 100.0, 1.0), 0.0) * 0.05, 6) AS blended FROM r"""


def tokens_ngrams(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", X.tokens("text", STOP_WORDS).alias("w"), X.terms("text", STOP_WORDS).alias("t")).select(
        "doc_id", F.size("w").cast("bigint").alias("words"), F.size("t").cast("bigint").alias("terms"),
        F.md5(F.array_join("t", "|")).alias("terms_md5"))


TOKENS_NGRAMS = f"""
WITH w AS (SELECT doc_id, {sql_words('text')} AS w FROM documents), t AS (SELECT doc_id, w, {sql_terms('w')} AS t FROM w)
SELECT doc_id, len(w) AS words, len(t) AS terms, md5(coalesce(array_to_string(t, '|'), '')) AS terms_md5 FROM t"""

CASES = {
    "lenient_cast": (lenient_cast, LENIENT_CAST),
    "lenient_date": (lenient_date, LENIENT_DATE),
    "text_normalise": (text_normalise, TEXT_NORMALISE),
    "json_names": (json_names, JSON_NAMES),
    "json_names_by_role": (json_names_by_role, JSON_NAMES_BY_ROLE),
    "json_scalar": (json_scalar, JSON_SCALAR),
    "nested_slice": (nested_slice, NESTED_SLICE),
    "shape_records": (shape_records, SHAPE_RECORDS),
    "shape_lists": (shape_lists, SHAPE_LISTS),
    "shape_links_ratings": (shape_links_ratings, SHAPE_LINKS_RATINGS),
    "sentiment_label": (sentiment_label, SENTIMENT_LABEL),
    "tokens_ngrams": (tokens_ngrams, TOKENS_NGRAMS),
}
