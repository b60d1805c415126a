"""Checks of joins, deduplication, quotas, selectors and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions.text import longer_than, weighted_text, word_count
from lakeloom.operators import presets as P
from lakeloom.operators import relational as R
from lakeloom.operators import selection as S
from lakeloom.operators.sentiment import usable_reviews
from lakeloom.plans.acquire import acquire
from lakeloom.suite.common import sql_collapse, sql_strip, table


def dedup_keep_first(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return R.keep_first(events, ["user_id", "event_type"], "event_id")


DEDUP_KEEP_FIRST = """
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events)
WHERE rn = 1"""


def union_first_wins_cap(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size",
                                           (-F.col("p_retailprice")).alias("position"))
    stages = [S.select_catalogue(part, languages=["PROMO"], min_votes=25, columns=dict(language="p_type", votes="p_size")),
              S.select_catalogue(part, languages=["Brand#12", "Brand#7"], columns=dict(language="p_brand")),
              part.where(F.col("p_name").endswith("ring")),
              part.where("p_size <= 10")]
    sold = table(spark, sf, "lineitem").where("l_returnflag = 'R' and l_quantity >= 48").select(
        F.col("l_partkey").alias("p_partkey"))
    return R.first_wins_union(stages, ["p_partkey"], "position", existing=sold, cap=200)


UNION_FIRST_WINS_CAP = """
WITH p AS (SELECT p_partkey, p_name, p_type, p_brand, p_size, -p_retailprice AS position FROM part),
c AS (SELECT *, 1::BIGINT AS stage FROM p WHERE p_type = 'PROMO' AND p_size >= 25
  UNION ALL SELECT *, 2 FROM p WHERE p_brand IN ('Brand#12', 'Brand#7')
  UNION ALL SELECT *, 3 FROM p WHERE p_name LIKE '%ring'
  UNION ALL SELECT *, 4 FROM p WHERE p_size <= 10),
n AS (SELECT * FROM c WHERE p_partkey NOT IN (
  SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 48)),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY stage, position) AS rn FROM n)
SELECT p_partkey, p_name, p_type, p_brand, p_size, position, stage FROM r WHERE rn = 1
ORDER BY stage, position, p_partkey LIMIT 200"""


def incremental_exclude(spark, sf):
    from lakeloom.sources.readers import existing_keys
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_totalprice")
    return R.exclude_existing(orders, existing_keys(table(spark, sf, "lineitem"), "l_orderkey"), ["l_orderkey"])


INCREMENTAL_EXCLUDE = """
SELECT o_orderkey AS l_orderkey, o_custkey, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""


def group_quota(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return R.top_per_group(orders, ["o_orderpriority"], [F.desc("o_totalprice"), F.asc("o_orderkey")],
                           R.group_quota(1000, 5))


GROUP_QUOTA = """
SELECT o_orderkey, o_orderpriority, o_totalprice, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
WHERE rank <= greatest(5, 1000 // 5)"""


#: Rows per group, and rows in all, beyond the number that Spark ranks within tasks.
LARGE_QUOTA, LARGE_TARGET = 3000, 6000


def group_quota_large(spark, sf):
    """Quotas of thousands; one group has most of the rows, and many rows share a value."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_discount") > 0.02, "most").when(F.col("l_tax") > 0.02, F.col("l_returnflag")).alias("kind"))
    return R.first_per_group(lines, ["kind"], "l_quantity", LARGE_QUOTA, [F.asc("l_orderkey"), F.asc("l_linenumber")], descending=True)


GROUP_QUOTA_LARGE = f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity,
  CASE WHEN l_discount > 0.02 THEN 'most' WHEN l_tax > 0.02 THEN l_returnflag END AS kind FROM lineitem)
SELECT l_orderkey, l_linenumber, l_quantity, kind,
  row_number() OVER (PARTITION BY kind ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS rank FROM l
QUALIFY rank <= {LARGE_QUOTA}"""


def null_keys_split(spark, sf):
    """A third of both sides without a key: their pairs are dealt to many tasks.

    Orders of one customer pair alike, so they are joined as one row with their number.
    """
    orders = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey")).alias("cust"))
    customer = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey")).alias("key"), "c_name")
    alike = orders.groupBy("cust").agg(F.count("*").alias("rows"))
    joined = R.left_join(alike, customer, "cust", "key", max_pairs=50_000)
    return joined.groupBy("cust").agg(
        F.sum("rows").alias("pairs"), F.sum(F.when(F.col("c_name").isNotNull(), F.col("rows")).otherwise(0)).alias("matched"),
        F.max("c_name").alias("last_name"))


NULL_KEYS_SPLIT = """
WITH o AS (SELECT CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS cust FROM orders),
c AS (SELECT CASE WHEN c_custkey % 3 > 0 THEN c_custkey END AS key, c_name FROM customer),
l AS (SELECT cust, count(*) AS rows FROM o GROUP BY 1), r AS (SELECT key, count(*) AS rows, max(c_name) AS name FROM c GROUP BY 1)
SELECT cust, l.rows * coalesce(r.rows, 1) AS pairs, l.rows * coalesce(r.rows, 0) AS matched, name AS last_name
FROM l LEFT JOIN r ON cust IS NOT DISTINCT FROM key"""


def lookup_with_fallback(spark, sf):
    name = (F.when(F.col("s_acctbal") > 5000, F.concat(F.lit(" Nation_"), "s_nationkey"))
            .when(F.col("s_acctbal") > 0, F.col("s_nationkey").cast("string")).otherwise(F.col("s_name")))
    codes = table(spark, sf, "nation").select(F.lower("n_name").alias("name"), F.col("n_nationkey").alias("code"))
    wanted = table(spark, sf, "supplier").select("s_suppkey", name.alias("wanted"))
    return R.lookup_code(wanted, "wanted", codes, "name", "code")


LOOKUP_WITH_FALLBACK = """
WITH w AS (SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN ' Nation_' || s_nationkey
  WHEN s_acctbal > 0 THEN s_nationkey::VARCHAR ELSE s_name END AS wanted FROM supplier)
SELECT s_suppkey, wanted, coalesce(n_nationkey::BIGINT, try_cast(wanted AS BIGINT)) AS code
FROM w LEFT JOIN nation ON lower(n_name) = trim(lower(wanted))
WHERE coalesce(n_nationkey::BIGINT, try_cast(wanted AS BIGINT)) IS NOT NULL"""


def select_catalogue(spark, sf):
    part = table(spark, sf, "part").withColumn("tags", F.split("p_name", " "))
    chosen = S.select_catalogue(
        part, keyword="ring", languages=["PROMO", "SMALL", "LARGE"], min_votes=10, min_rating=905.0,
        released=("Brand#1", "Brand#19"), order=[F.desc("p_retailprice"), F.asc("p_partkey")],
        columns=dict(keywords="tags", language="p_type", votes="p_size", rating="p_retailprice", date="p_brand"))
    return chosen.select("p_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice")


SELECT_CATALOGUE = """
SELECT p_partkey, p_name, p_type, p_brand, p_size, p_retailprice FROM part
WHERE list_contains(string_split(p_name, ' '), 'ring') AND p_type IN ('PROMO', 'SMALL', 'LARGE')
  AND p_size >= 10 AND p_retailprice >= 905.0 AND p_brand BETWEEN 'Brand#1' AND 'Brand#19'
ORDER BY p_retailprice DESC, p_partkey"""


def year_range_filter(spark, sf):
    day = F.col("o_orderdate").cast("date").cast("string")
    text = (F.when(F.col("o_orderpriority") == "1-URGENT", day)
            .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.substring(day, 1, 4), F.lit("/x")))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.substring(day, 1, 3))
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(F.lit("abcd"), F.substring(day, 5, 6))))
    orders = table(spark, sf, "orders").select("o_orderkey", text.alias("date_text"))
    return orders.where(S.year_in_range("date_text", 1996, 1999))


YEAR_RANGE_FILTER = """
WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderpriority AS p FROM orders),
t AS (SELECT o_orderkey, CASE p WHEN '1-URGENT' THEN d WHEN '2-HIGH' THEN substr(d, 1, 4) || '/x'
  WHEN '3-MEDIUM' THEN substr(d, 1, 3) WHEN '4-NOT SPECIFIED' THEN 'abcd' || substr(d, 5, 6) END AS date_text FROM o)
SELECT o_orderkey, date_text FROM t
WHERE coalesce(length(date_text), 0) < 4
  OR coalesce(try_cast(substr(date_text, 1, 4) AS INTEGER) BETWEEN 1996 AND 1999, true)"""


def tiered_threshold(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    votes = (F.col("quality") + F.col("toxic")) * 500
    return docs.where(S.is_presentable("source", "text", 30)
                      & S.meets_threshold("lang", "n_chars", votes, home=(1500, 500), other=(900, 5))
                      ).select("doc_id", "lang", "n_chars")


TIERED_THRESHOLD = """
SELECT d.doc_id, lang, n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE coalesce(source, '') <> '' AND length(coalesce(text, '')) >= 30
  AND CASE WHEN coalesce(lang, 'en') = 'en'
    THEN coalesce(n_chars, 0) >= 1500 OR coalesce((quality + toxic) * 500, 0) >= 500
    ELSE coalesce(n_chars, 0) >= 900 OR coalesce((quality + toxic) * 500, 0) >= 5 END"""


def left_join_features(spark, sf):
    sales = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return R.left_join(R.left_join(part, sales, "p_partkey", "l_partkey"), docs, "p_partkey", "doc_id")


LEFT_JOIN_FEATURES = """
SELECT p_partkey, p_name, p_brand, lines, quantity, lang, n_chars FROM part
LEFT JOIN (SELECT l_partkey, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1)
  ON p_partkey = l_partkey
LEFT JOIN documents ON p_partkey = doc_id"""


def null_safe_left_join(spark, sf):
    customer = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")).alias("nation_key"))
    nation = table(spark, sf, "nation").select(
        F.when(F.col("n_nationkey") < 20, F.col("n_nationkey")).alias("n_key"), "n_name")
    return R.left_join(customer, nation, "nation_key", "n_key")


NULL_SAFE_LEFT_JOIN = """
SELECT c_custkey, nation_key, n_name
FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS nation_key FROM customer)
LEFT JOIN (SELECT CASE WHEN n_nationkey < 20 THEN n_nationkey END AS n_key, n_name FROM nation)
  ON nation_key IS NOT DISTINCT FROM n_key"""


def source_fallback(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return R.fallback_sources([orders.where("o_orderstatus = 'O' and o_totalprice > 400000"),
                               orders.where("o_orderstatus = 'P'"), orders], "o_custkey", "o_orderkey")


SOURCE_FALLBACK = """
WITH c AS (SELECT *, 1::BIGINT AS stage FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 400000
  UNION ALL SELECT *, 2 FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT *, 3 FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY stage, o_orderkey) AS rn FROM c)
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, stage FROM r WHERE rn = 1"""


def coverage_argmax(spark, sf):
    part = table(spark, sf, "part")
    words = part.select("p_partkey", "p_brand", F.explode(F.split("p_name", " ")).alias("word"))
    candidates = words.groupBy("word", F.col("p_brand").alias("tag")).agg(F.min("p_partkey").alias("position"))
    items = part.select(F.array("p_brand", "p_type", "p_brand").alias("tags"))
    overrides = words.where("word = 'ring'").groupBy("word").agg(F.max("p_brand").alias("tag"))
    return R.resolve_tags(words.select("word"), "word", candidates, items, "tags", overrides)


COVERAGE_ARGMAX = """
WITH w AS (SELECT p_partkey, p_brand, unnest(string_split(p_name, ' ')) AS word FROM part),
c AS (SELECT word, p_brand AS tag, min(p_partkey) AS position FROM w GROUP BY 1, 2),
f AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY position) AS rn FROM c),
n AS (SELECT p_brand AS tag, count(*) AS items FROM part GROUP BY 1),
b AS (SELECT word, tag, items, row_number() OVER (PARTITION BY word ORDER BY items DESC, position) AS best
  FROM f JOIN n USING (tag) WHERE rn <= 5),
o AS (SELECT word, max(p_brand) AS tag FROM w WHERE word = 'ring' GROUP BY 1)
SELECT b.word, coalesce(o.tag, b.tag) AS tag, CASE WHEN o.tag IS NULL THEN items END AS items
FROM b LEFT JOIN o USING (word) WHERE best = 1"""


def _listing(spark, sf):
    """A catalogue listing made of the parts."""
    size, price = F.col("p_size"), F.col("p_retailprice")
    brand = F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("int")
    language = (F.when(brand == 3, "ja").when(brand.between(4, 6), "ko").when(brand.between(7, 9), "fr")
                .when(brand == 10, "vi").otherwise("en"))
    genre = (F.when(size <= 8, 28).when(size <= 16, 12).when(size <= 24, 16).when(size <= 32, 18).otherwise(1))
    keyword = F.when(brand == 1, 9715).when(brand == 2, 12190).when(brand == 3, 210024).otherwise(2)
    day = F.concat((F.lit(1960) + size).cast("string"), F.lit("-06-15"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_type") == "PROMO", "tv").otherwise("movie").alias("media_type"),
        F.array(genre, F.lit(99) + size * 0).alias("genre_ids"), F.array(keyword).alias("keyword_ids"),
        language.alias("original_language"), day.alias("release_date"), day.alias("first_air_date"),
        (size * 11).alias("vote_count"), (size / 5.0).alias("vote_average"), price.alias("popularity"),
        F.when(size == 50, F.col("p_partkey")).alias("trending_rank"),
        F.concat(F.lit("a part of the catalogue: "), "p_name").alias("overview"),
        F.when(F.col("p_name") != "red plate", F.col("p_name")).alias("poster_path"),
        (size * 2).alias("runtime"))


def staged_acquisition(spark, sf, target=600):
    sold = table(spark, sf, "lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("id"))
    return acquire(_listing(spark, sf), target, existing=sold, genres=["Action", "adventure", "16", "nonsense"],
                   languages=["ja", "ko", "fr", "vi"])


def staged_acquisition_large(spark, sf):
    """A target, and so a quota, beyond what one task ranks."""
    return staged_acquisition(spark, sf, LARGE_TARGET)


def _staged_sql(target: int = 600) -> str:
    movie, dated = "media_type = 'movie'", "d BETWEEN '1970-01-01' AND '2026-12-31'"
    keys = [(1, n, f"{movie} AND g = {c} AND v >= 25 AND {dated}", "pop")
            for n, c in (("Action", 28), ("adventure", 12), ("16", 16))]
    keys += [(2, n, f"{movie} AND k = {c} AND v >= 20", "v") for n, c in P.KEYWORD_IDS.items()]
    keys += [(3, c, f"{movie} AND lang = '{c}' AND v >= {m}", "v") for _, c, m in P.REGIONS if c in ("ja", "ko", "fr", "vi")]
    keys += [(4, f"{a}-{b}", f"{movie} AND d BETWEEN '{a}-01-01' AND '{b}-12-31' AND v >= 30", "v") for a, b in P.ERAS]
    keys += [(5, "popular", f"{movie} AND {dated} AND v >= 30", "pop"),
             (6, "classics", f"{movie} AND {dated} AND v >= 60", "v"),
             (7, "trending", f"{movie} AND s = 50", "-id"),
             (8, "cult", f"{movie} AND {dated} AND rating >= 7.8 AND v >= 15", "pop"),
             (9, "anime", f"{movie} AND g = 16 AND lang = 'ja' AND v >= 15", "pop")]
    keys += [(10, n, f"media_type = 'tv' AND g = {P.TV_GENRES[n]} AND v >= 25 AND {dated}", "pop")
             for n in P.TV_STAGE_GENRES]
    claims = "\nUNION ALL ".join(
        f"SELECT id, {s} AS stage, {i} AS key_no, '{n}' AS key, ({o})::DOUBLE AS sort FROM ok WHERE {p}"
        for i, (s, n, p, o) in enumerate(keys))
    return f"""
WITH b AS (SELECT *, replace(p_brand, 'Brand#', '')::INTEGER AS brand FROM part),
l AS (SELECT p_partkey AS id, p_size AS s, p_size * 11 AS v, p_retailprice AS pop, p_size / 5.0 AS rating,
  CASE WHEN p_type = 'PROMO' THEN 'tv' ELSE 'movie' END AS media_type,
  CASE WHEN p_size <= 8 THEN 28 WHEN p_size <= 16 THEN 12 WHEN p_size <= 24 THEN 16 WHEN p_size <= 32 THEN 18 ELSE 1 END AS g,
  CASE brand WHEN 1 THEN 9715 WHEN 2 THEN 12190 WHEN 3 THEN 210024 ELSE 2 END AS k,
  CASE WHEN brand = 3 THEN 'ja' WHEN brand BETWEEN 4 AND 6 THEN 'ko' WHEN brand BETWEEN 7 AND 9 THEN 'fr'
    WHEN brand = 10 THEN 'vi' ELSE 'en' END AS lang,
  (1960 + p_size)::VARCHAR || '-06-15' AS d, p_name, p_size * 2 AS runtime FROM b),
ok AS (SELECT * FROM l WHERE substr(d, 1, 4)::INTEGER BETWEEN 1970 AND 2026 AND p_name <> 'red plate'
  AND (media_type = 'tv' OR CASE WHEN lang = 'en' THEN runtime >= 40 OR v >= 500 ELSE runtime >= 30 OR v >= 5 END)
  AND id NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)),
claims AS ({claims}),
early AS (SELECT * FROM claims WHERE stage < 3 QUALIFY row_number() OVER (PARTITION BY id ORDER BY key_no) = 1),
waiting AS (SELECT * FROM claims WHERE stage = 3 AND id NOT IN (SELECT id FROM early)),
won AS (SELECT * FROM waiting QUALIFY row_number() OVER (PARTITION BY key_no ORDER BY sort DESC, id) <= greatest(5, {target} // 4)),
late AS (SELECT * FROM claims WHERE stage > 3 AND id NOT IN (SELECT id FROM early) AND id NOT IN (SELECT id FROM won)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY key_no) = 1),
u AS (SELECT * FROM early UNION ALL SELECT * FROM won UNION ALL SELECT * FROM late)
SELECT id, stage::BIGINT AS stage, key, row_number() OVER (ORDER BY key_no, sort DESC, id) AS position FROM u
QUALIFY position <= {target}"""


def min_words(spark, sf):
    docs = table(spark, sf, "documents").where(longer_than("text", 20))
    return usable_reviews(docs, "text", 10).select("doc_id", word_count("text").cast("bigint").alias("words"))


MIN_WORDS = f"""
WITH c AS (SELECT doc_id, text, {sql_collapse('text')} AS t FROM documents),
w AS (SELECT doc_id, text, CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, ' ', '')) + 1 END AS words FROM c)
SELECT doc_id, words FROM w WHERE words >= 10 AND length({sql_strip('text')}) > 20"""


def weighted_soup(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", weighted_text([("p_name", 1), ("p_type", 2), ("p_brand", 3)]).alias("soup"))


WEIGHTED_SOUP = """
SELECT p_partkey, trim(concat_ws(' ', p_name, repeat(p_type || ' ', 2) || repeat(p_brand || ' ', 3))) AS soup FROM part"""


def slim_index(spark, sf):
    from lakeloom.operators.recommend import slim_index as slim
    first = R.top_n(table(spark, sf, "part"), [F.asc("p_partkey")], 1).select(F.col("p_name").alias("first_name"))
    index = slim(table(spark, sf, "part"), ["p_partkey", "p_name", "p_retailprice"])
    return index.withColumn("first_name", first.scalar())


SLIM_INDEX = """
SELECT p_partkey, p_name, p_retailprice, (SELECT p_name FROM part ORDER BY p_partkey LIMIT 1) AS first_name FROM part"""

CASES = {
    "dedup_keep_first": (dedup_keep_first, DEDUP_KEEP_FIRST),
    "union_first_wins_cap": (union_first_wins_cap, UNION_FIRST_WINS_CAP),
    "incremental_exclude": (incremental_exclude, INCREMENTAL_EXCLUDE),
    "group_quota": (group_quota, GROUP_QUOTA),
    "group_quota_large": (group_quota_large, GROUP_QUOTA_LARGE),
    "null_keys_split": (null_keys_split, NULL_KEYS_SPLIT),
    "lookup_with_fallback": (lookup_with_fallback, LOOKUP_WITH_FALLBACK),
    "select_catalogue": (select_catalogue, SELECT_CATALOGUE),
    "year_range_filter": (year_range_filter, YEAR_RANGE_FILTER),
    "tiered_threshold": (tiered_threshold, TIERED_THRESHOLD),
    "left_join_features": (left_join_features, LEFT_JOIN_FEATURES),
    "null_safe_left_join": (null_safe_left_join, NULL_SAFE_LEFT_JOIN),
    "source_fallback": (source_fallback, SOURCE_FALLBACK),
    "coverage_argmax": (coverage_argmax, COVERAGE_ARGMAX),
    "staged_acquisition": (staged_acquisition, _staged_sql()),
    "staged_acquisition_large": (staged_acquisition_large, _staged_sql(LARGE_TARGET)),
    "min_words": (min_words, MIN_WORDS),
    "weighted_soup": (weighted_soup, WEIGHTED_SOUP),
    "slim_index": (slim_index, SLIM_INDEX),
}
