import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import recommend as R
from lakeloom.operators import tfidf as T
from lakeloom.operators.titles import TitleIndex
from lakeloom.sources.readers import MissingInput

ANSWER = {"id": "id", "title": "title"}


def brute_weights(texts, min_df, max_terms):
    docs = []
    for text in texts:
        words = re.findall(r"\b\w\w+\b", text.lower())
        docs.append(Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))
    df, cf = Counter(), Counter()
    for d in docs:
        df.update(d.keys())
        cf.update(d)
    kept = sorted((t for t in df if df[t] >= min_df), key=lambda t: (-cf[t], t))[:max_terms]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}
    out = []
    for d in docs:
        w = {t: (1 + math.log(n)) * idf[t] for t, n in d.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.append({t: x / norm for t, x in w.items()})
    return sorted(kept), out


def brute_top(weights, items, own, k, boost):
    scored = []
    for row, (item, w) in enumerate(zip(items, weights)):
        sim = -1.0 if row == own else sum(x * weights[own].get(t, 0.0) for t, x in w.items())
        final = sim
        if boost:
            final = sim * 0.8 + min(max(item["rating"] / 10, 0), 1) * 0.15 + min(max(item["popularity"] / 100, 0), 1) * 0.05
        scored.append((-round(final, 9), item["id"], sim, final))
    return [(i, s, f) for _, i, s, f in sorted(scored)[:k]]


def catalogue(spark, seed, n=40):
    rng = random.Random(seed)
    words = ["red", "blue", "old", "hot", "ring", "bolt", "rod", "plate", "x1", "the"]
    items = [{"id": 100 + i, "title": f"t{i}", "text": " ".join(rng.choices(words, k=rng.randint(0, 6))),
              "rating": rng.choice([0.0, 5.0, 10.0, 12.0]), "popularity": rng.choice([0.0, 50.0, 500.0])} for i in range(n)]
    schema = "id long, title string, text string, rating double, popularity double"
    return items, spark.createDataFrame([tuple(i.values()) for i in items], schema)


def test_vocabulary_and_weights_equal_brute_force(spark):
    items, df = catalogue(spark, 3)
    kept, weights = brute_weights([i["text"] for i in items], 2, 25)
    vocab = T.vocabulary(df, "text", max_terms=25).orderBy("index").collect()
    assert [(r["term"], r["index"]) for r in vocab] == [(t, n) for n, t in enumerate(kept)]
    got = {(r.id, r.term): r.weight for r in T.weights(df, "id", "text", max_terms=25).collect()}
    expected = {(i["id"], t): x for i, w in zip(items, weights) for t, x in w.items()}
    assert got == pytest.approx(expected)


@pytest.mark.parametrize("seed, k, boost, n, broadcast", [
    (1, 5, True, 40, True), (2, 5, False, 40, True), (3, 12, True, 9, True), (4, 7, True, 40, False), (5, 3, False, 40, False)])
def test_top_k_equals_scoring_every_pair(spark, monkeypatch, seed, k, boost, n, broadcast):
    if not broadcast:
        monkeypatch.setattr(R, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(R, "HOT_TERM_ROWS", 3)
        monkeypatch.setattr(R, "FEW_TERMS", 0)
        monkeypatch.setattr(R, "LEADERS", 2)
        monkeypatch.setattr("lakeloom.operators.relational.PUSHED_KEYS", 0)
    items, df = catalogue(spark, seed, n)
    _, weights = brute_weights([i["text"] for i in items], 2, 20_000)
    index = R.ItemIndex.build(df, text="text", row="id", rating="rating", columns=["title"])
    queries = spark.createDataFrame([(i, str(item["id"])) for i, item in enumerate(items)], "query_id int, query string")
    got = {}
    for r in index.recommend(queries, k, boost, ANSWER).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id, r.similarity_score, r.final_score))
    for own in range(n):
        best = brute_top(weights, items, own, k, boost)
        assert [g[:2] for g in got[own]] == [(j, b[0]) for j, b in enumerate(best, 1)]
        for g, b in zip(got[own], best):
            assert g[2:] == pytest.approx((b[1], b[2]), abs=6e-5)


def test_stored_index_opens_again_and_open_readers_stay(spark, tmp_path):
    tmp_path = tmp_path / "it's here"
    _, df = catalogue(spark, 6)
    path = str(tmp_path / "i")
    built = R.ItemIndex.build(df, text="text", rating="rating", columns=["title"], path=path, buckets=3, keep=2)
    queries = spark.createDataFrame([(1, "t3"), (2, "104"), (3, "nothing like it")], "query_id int, query string")
    answers = lambda index: sorted(map(tuple, index.recommend(queries, 4, answer=ANSWER).collect()))
    first = answers(built)
    assert {r[0] for r in first} == {1, 2} and len(first) == 8
    assert answers(R.ItemIndex.load(spark, path)) == first
    rebuilt = R.ItemIndex.build(df.limit(20), text="text", rating="rating", columns=["title"], path=path, buckets=2, keep=2)
    # The first reader still answers from its own version; a build that stops half-way changes nothing.
    assert answers(built) == first and answers(R.ItemIndex.load(spark, path)) == answers(rebuilt) != first
    with pytest.raises(Exception):
        R.ItemIndex.build(df, text="none", path=path)
    assert answers(R.ItemIndex.load(spark, path)) == answers(rebuilt)
    with pytest.raises(MissingInput):
        R.ItemIndex.load(spark, str(tmp_path / "none"))


def test_a_request_reads_the_postings_of_its_terms(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    rows = [(i, f"t{i}", " ".join(["common"] + rng.choices(words, k=20)), 0.0, 0.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, title string, text string, rating double, popularity double")
    index = R.ItemIndex.build(df, text="text", row="id", rating="rating", columns=["title"], stop_words=(), buckets=2)
    one = spark.createDataFrame([(1, 7)], "query_id int, own long")
    terms = index.query_terms(one, 1).join(index.vocabulary.where("df < 100"), "index")
    seen = R.picked(index.postings, "index", terms)
    plan = seen._jdf.queryExecution().executedPlan()
    seen.collect()
    read = [int(leaf.metrics().get("numOutputRows").get().value()) for leaf in
            (plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size())) if leaf.metrics().contains("numOutputRows")]
    assert 0 < sum(read) < index.postings.count() / 4
    assert index._scores(one, 1, 3, False).count() == 3
    # For many terms sums are complete in a bucket: nothing but the best rows of each task is shuffled.
    plan = index._sums(terms.select("query_id", "index", "query_weight"), 10 ** 6)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(query_id" not in plan and "Bucketed: true" in plan


def test_repeated_ids_are_separate_items(spark):
    df = spark.createDataFrame([(1, "a", "red ring"), (2, "b", "red ring"), (2, "c", "red bolt"), (None, "d", "red ring")],
                               "id long, title string, text string").coalesce(1)
    df = df.selectExpr("*", "0.0 as vote_average", "0.0 as popularity")
    index = R.ItemIndex.build(df, text="text", columns=["title"], min_df=1)
    out = index.recommend(spark.createDataFrame([(1, "2")], "query_id int, query string"), 5, answer=ANSWER)
    # The id stands for its last row; the row without an id is no item.
    assert [r.title for r in out.orderBy("rank").collect()] == ["a", "b", "c"]


def test_resolution(spark):
    items = spark.createDataFrame(
        [(0, 5, "Up"), (1, 6, "The Up Side"), (2, 7, " UP "), (3, 7, "1917"), (4, None, "Ghost"), (5, 8, "Upside"), (6, 9, None)],
        "row int, id int, title string")
    queries = spark.createDataFrame(
        [(1, "up"), (2, "7"), (3, "1917"), (4, "side"), (5, "zzz"), (6, ""), (7, "ghost"), (8, "e u"), (9, "p")],
        "query_id int, query string")
    got = {r.query_id: r.row for r in R.resolve_items(queries, items, "row").collect()}
    assert got == {1: 2, 2: 3, 4: 1, 6: 2, 8: 1, 9: 2}


def test_titles_that_begin_alike(spark):
    titles = [(i, i, f"the long common beginning {i:05d} x") for i in range(4000)] + [(9000, 9000, "the"), (9001, 9001, "zebra crossing")]
    items = spark.createDataFrame(titles, "row long, id long, title string")
    index = TitleIndex.build(items, "row")
    queries = spark.createDataFrame(
        [(1, "The long COMMON beginning 03999 x"), (2, "beginning 0123"), (3, "common beginning 9"), (4, "bra cro"), (5, "th"),
         (6, "g 03999 "), (7, "the long common beginning"), (8, "x"), (9, "the"), (10, "a crossing")], "query_id int, query string")
    want = {}
    for q in queries.collect():
        text = q.query.lower().strip()
        rows = [r for r, _, t in titles if t == text] or [r for r, _, t in titles if text in t][:1]
        if rows:
            want[q.query_id] = rows[-1]
    assert {r.query_id: r.row for r in index.find(queries).collect()} == want
    # The rarest gram decides how many titles are looked at.
    asked = queries.where("query_id in (2, 4)").selectExpr("query_id", "lower(query) AS text")
    looked = index.rarest(asked).join(index.counts, "gram").collect()
    assert {r.query_id: r.titles for r in looked}[4] == 1 and all(r.titles <= 400 for r in looked)


def test_resolution_equals_brute_force(spark):
    rng = random.Random(12)
    titles = [(i, 100 + i % 37, "".join(rng.choices("ab é", k=rng.randint(0, 9)))) for i in range(150)]
    items = spark.createDataFrame(titles, "row long, id long, title string")
    asked = [(i, "".join(rng.choices("ab é", k=rng.randint(0, 5)))) for i in range(120)] + [(500 + i, str(95 + i)) for i in range(50)]
    first, last = {}, {}
    for row, _, title in titles:
        key = title.strip()
        first.setdefault(key, row)
        last[key] = row
    want = {}
    for q, text in asked:
        if text.isdigit():
            rows = [r for r, i, _ in titles if i == int(text)]
        else:
            text = text.strip()
            found = [text] if text in first else sorted((t for t in first if text in t), key=first.get)[:1]
            rows = [last[t] for t in found]
        if rows:
            want[q] = rows[-1]
    got = R.resolve_items(spark.createDataFrame(asked, "query_id int, query string"), items, "row")
    assert {r.query_id: r.row for r in got.collect()} == want


def test_more_text_is_counted_by_more_tasks(spark, tmp_path, monkeypatch):
    df = spark.range(400).select("id", F.concat_ws(" ", *[F.concat(F.lit(f"w{i}x"), F.col("id") % 7) for i in range(20)]).alias("text"))
    df.repartition(4).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    vocab = T.vocabulary(docs, "text").select("term", "index")
    few = T.term_counts(docs, "id", "text", vocab, 20_000)
    monkeypatch.setattr(T, "TASK_INPUT", 200, raising=False)
    many = T.term_counts(docs, "id", "text", vocab, 20_000)
    assert many.rdd.getNumPartitions() > 10 > few.rdd.getNumPartitions()
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))


@pytest.mark.parametrize("hashes", ["own", "crowded", "one"])
def test_terms_are_counted_by_numbers(spark, monkeypatch, hashes):
    texts = [None, "", "red red ring red red", "red ring", "blue red ring blue", "old blue", "zinc zinc zinc", "old bolt bolt"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    if hashes != "own":
        monkeypatch.setattr(T, "_hash", lambda *words: F.pmod(F.xxhash64(*words), F.lit(5 if hashes == "crowded" else 1)))
    named = []
    monkeypatch.setattr(T, "term_statistics", lambda *args, found=T.term_statistics: named.append(1) or found(*args))
    for n in (3, 100):
        kept, _ = brute_weights([t or "" for t in texts], 2, n)
        got = T.vocabulary(df, "text", max_terms=n).orderBy("index").collect()
        assert [r.term for r in got] == kept
        cells = [re.findall(r"\w\w+", t or "") for t in texts]
        terms = [Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]) for w in cells]
        assert [(r.df, r.cf) for r in got] == [(sum(t in c for c in terms), sum(c[t] for c in terms)) for t in kept]
    # Terms are counted by their text only where two of them share a number.
    assert bool(named) == (hashes != "own")
    counting = T._hash_statistics(df, "text", ())._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", counting) == ["h"]


def test_many_equal_counts_at_the_cut_are_not_cut(spark, monkeypatch):
    words = [f"w{i:03d}" for i in range(120)]
    df = spark.createDataFrame([(w,) for w in words * 2], "text string")
    want = words[:50]
    assert [r.term for r in T.vocabulary(df, "text", max_terms=50).orderBy("index").collect()] == want
    monkeypatch.setattr(T, "BROADCAST_TERMS", 60)
    assert [r.term for r in T.vocabulary(df, "text", max_terms=50).orderBy("index").collect()] == want
