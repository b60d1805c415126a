import json
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.quality import audit_layer, audited, table_profile
from lakeloom.plans import medallion as L
from lakeloom.sources.readers import MissingInput, read_landing, read_text_table
from lakeloom.sources.schemas import BRONZE
from lakeloom.sources.writers import append_batch, known_keys
from lakeloom.streaming.ingest import micro_ingest

GOOD = "A superb film with great music, loved every single scene of this wonderful story."
BAD = "An awful film with boring music, hated every single scene of this terrible story."


def record(i, **more):
    good = i % 4 != 0
    return {
        "id": i, "title": f"Film {i % 20}", "overview": f"  An   overview number {i} \n of the story ", "poster_path": "/p",
        "imdb_id": f"tt{i}", "original_language": "cn" if i % 5 == 0 else "EN ", "release_date": f"{1990 + i % 30}-0{1 + i % 9}-15",
        "runtime": 90 + i, "budget": 10 * i, "revenue": 0, "popularity": i * 1.5, "vote_average": (i % 10) + 0.5,
        "vote_count": i, "status": "Released", "tagline": "x, \"y\"", "media_type": "movie",
        "genres": [{"name": "Drama"}, {"name": "War" if i % 2 else "Crime"}], "production_companies": [{"name": f"P{i % 3}"}],
        "production_countries": [], "spoken_languages": [],
        "credits": {"cast": [{"name": f"Actor {i % 7}"}], "crew": [{"name": f"Dir {i % 6}", "job": "Director"},
                                                                  {"name": f"Dir {i % 6}", "job": "Writer"}]},
        "keywords": {"keywords": [{"name": "space"}, {"name": f"kw{i % 4}"}]},
        "reviews": {"results": [
            {"id": f"rev{i}", "content": (GOOD if good else BAD) + f" No {i}.", "author_details": {"rating": 8.0 if good else 2.0}},
            {"id": f"short{i}", "content": "meh"}]}, **more}


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("flow")
    landing = root / "landing"
    landing.mkdir()
    (landing / "a.json").write_text("\n".join(json.dumps(record(i)) for i in range(1, 61)))
    dirs = {n: str(root / n) for n in ("bronze", "silver", "gold", "models")}
    L.land(read_landing(spark, str(landing)), dirs["bronze"])
    # The second crawl repeats some items with other titles, and one record is a failed fetch.
    again = [json.dumps(record(i, title="Changed")) for i in (1, 2, 3)] + [json.dumps({"id": 99, "media_type": "tv"})]
    late = root / "late"
    late.mkdir()
    (late / "b.json").write_text("\n".join(again))
    L.land(read_landing(spark, str(late)), dirs["bronze"])
    manifests = L.run_all(spark, dirs["bronze"], dirs["silver"], dirs["gold"], dirs["models"])
    return root, dirs, manifests


def test_silver(spark, flow):
    _, dirs, _ = flow
    movies = spark.read.parquet(f"{dirs['silver']}/silver_movies")
    assert len(movies.columns) == 24 and movies.count() == 60
    row = movies.where("id = 5").first()
    assert (row.title, row.original_language, row.release_date, row.runtime, row.genres_clean) == (
        "Film 5", "zh", "1995-06-15", 95, "Drama, War")
    assert movies.where("id = 1").first().title == "Film 1"
    credits = spark.read.parquet(f"{dirs['silver']}/silver_credits")
    assert len(credits.columns) == 7
    assert tuple(credits.where("id = 8").first())[3:] == ("Actor 1", "Dir 2", "Dir 2", "Dir 2, Dir 2")
    assert len(spark.read.parquet(f"{dirs['silver']}/silver_keywords").columns) == 3
    reviews = spark.read.parquet(f"{dirs['silver']}/silver_reviews")
    assert len(reviews.columns) == 7
    assert {r[0]: r[1] for r in reviews.groupBy("sentiment_label").count().collect()} == {"positive": 45, "negative": 15}


def test_gold(spark, flow):
    _, dirs, _ = flow
    gold = spark.read.parquet(f"{dirs['gold']}/gold_movies_features")
    assert len(gold.columns) == 21 and gold.count() == 60
    row = gold.where("id = 7").first()
    assert (row.release_year, row.director_clean, row.title) == (1997, "dir 1", "Film 7")
    assert row.metadata_soup == ("an overview number 7 of the story drama, war drama, war space, kw3 space, kw3 "
                                 "dir 1 dir 1 dir 1 actor 0 dir 1")


def test_manifests(spark, flow):
    _, dirs, manifests = flow
    bronze = manifests["bronze"].first()
    assert (bronze.total_tables, bronze.status) == (6, "SUCCESS")
    sizes = {t.table_name: (t.row_count, t.col_count) for t in bronze.tables}
    assert sizes["movies_metadata"] == (63, 21) and sizes["reviews"] == (63, 6)
    assert all(t.size_kb > 0 for t in bronze.tables)
    silver = manifests["silver"].first()
    assert (silver.total_tables, silver.total_rows) == (4, 240)
    assert all(t.duplicate_rows == 0 and t.null_keys == 0 for t in silver.tables)
    gold = manifests["gold"].first()
    assert (gold.row_count, gold.col_count, gold.null_soup, gold.empty_soup, gold.status) == (60, 21, 0, 0, "SUCCESS")
    assert (gold.recommender_status, gold.recommender_test, gold.sentiment_test) == ("READY", "PASSED", "PASSED")
    assert json.loads(gold.sentiment_metrics)["test_rows"] == 12
    assert spark.read.json(f"{dirs['silver']}/silver_manifest").first().total_rows == 240


def test_reports(spark, flow):
    _, dirs, _ = flow
    removed = {r.step: (r.rows_before, r.rows_after, r.rows_removed)
               for r in L.removed_report(spark, dirs["bronze"], dirs["silver"]).collect()}
    assert removed["silver_movies"] == (63, 60, 3) and removed["silver_reviews"] == (63, 60, 3)
    sizes = L.compression_report(spark, dirs["bronze"], dirs["silver"]).collect()
    assert len(sizes) == 4 and all(r.ratio == pytest.approx(r.text_kb / r.stored_kb, abs=0.01) for r in sizes)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_of_equal_titles_the_last_in_the_file_answers(spark, tmp_path, parts):
    dirs = {n: str(tmp_path / n) for n in ("bronze", "silver", "gold", "models")}
    ids = list(range(1, 41))
    random.Random(parts).shuffle(ids)
    (tmp_path / "a.json").write_text("\n".join(json.dumps(record(i, title="Same")) for i in ids))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        L.land(read_landing(spark, str(tmp_path / "a.json")).coalesce(1), dirs["bronze"])
        L.build_silver(spark, dirs["bronze"], dirs["silver"], text_copy=False)
        L.build_gold(spark, dirs["silver"], dirs["gold"], text_copy=False)
        index = L.train_recommender(spark, dirs["gold"], dirs["models"])
        found = index.resolve(spark.createDataFrame([(1, "same")], "query_id int, query string")).collect()
        assert index.items.where(F.col("row") == found[0].row).first().item == ids[-1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_build_that_fails_leaves_the_old_index(spark, flow, monkeypatch):
    _, dirs, _ = flow
    path = f"{dirs['models']}/recommender"
    before = sorted(r.row for r in L.ItemIndex.load(spark, path).items.collect())
    gold = spark.read.parquet(f"{dirs['gold']}/gold_movies_features").limit(3)
    monkeypatch.setattr("lakeloom.operators.recommend.vectors", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        L.ItemIndex.build(gold, path=path)
    index = L.ItemIndex.load(spark, path)
    assert sorted(r.row for r in index.items.collect()) == before == sorted(r.row for r in index.vectors.collect())


def test_recommender_answers_by_title(spark, flow):
    _, dirs, _ = flow
    index = L.ItemIndex.load(spark, f"{dirs['models']}/recommender")
    queries = spark.createDataFrame([("a", "film 3"), ("b", "12"), ("c", "missing")], "query_id string, query string")
    out = index.recommend(queries, 3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank) for r in out] == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 3)]
    assert out[0].asDict().keys() == {"query_id", "rank", "movieId", "title", "release_year", "genres", "director",
                                      "language", "vote_average", "similarity_score", "final_score"}


def test_missing_layers(spark, tmp_path):
    with pytest.raises(MissingInput):
        L.run_all(spark, str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / "g"), str(tmp_path / "m"))
    with pytest.raises(MissingInput):
        L.build_gold(spark, str(tmp_path / "s"), str(tmp_path / "g"))
    empty = audit_layer({"x": None}, "Bronze", "p").first()
    assert (empty.status, empty.total_tables, empty.total_rows, empty.tables) == ("EMPTY", 0, 0, [])


def test_silver_keys_as_raw_text_or_as_numbers(spark):
    rows = [("1", '[{"name":"a"}]'), ("01", '[{"name":"b"}]'), ("1", '[{"name":"c"}]'), (None, "[]"), (None, "bad")]
    bronze = spark.createDataFrame(rows, "id string, keywords string").coalesce(1)
    raw = [(r.id, r.keywords_clean) for r in L.silver_keywords(bronze).collect()]
    assert sorted(raw, key=str) == [(1, "a"), (1, "b"), (None, "")]
    numbers = [(r.id, r.keywords_clean) for r in L.silver_keywords(bronze, normalise_key=True).collect()]
    assert sorted(numbers, key=str) == [(1, "a"), (None, "")]


def test_unmatched_items_keep_null_names(spark, flow):
    _, dirs, _ = flow
    movies, credits, keywords = (spark.read.parquet(f"{dirs['silver']}/{t}") for t in (
        "silver_movies", "silver_credits", "silver_keywords"))
    row = L.gold_features(movies, credits.where("id <> 4"), keywords).where("id = 4").first()
    assert (row.director_clean, row.all_crew_clean) == ("", None)
    assert row.metadata_soup.endswith("space, kw0 space, kw0")


def test_on_demand_stream_appends_once(spark, flow):
    root, dirs, _ = flow
    landing = root / "demand"
    landing.mkdir()

    def drop(name, *ids):
        (landing / name).write_text("\n".join(json.dumps(record(i)) for i in ids))

    def run():
        micro_ingest(spark, str(landing), dirs["bronze"], str(root / "checkpoint")).awaitTermination()
        return {t: read_text_table(spark, f"{dirs['bronze']}/{t}", BRONZE[t]).count() for t in ("movies_metadata", "reviews", "credits")}

    drop("1.json", 5, 200, 201, 200)
    assert run() == {"movies_metadata": 65, "reviews": 65, "credits": 63}
    assert run() == {"movies_metadata": 65, "reviews": 65, "credits": 63}
    drop("2.json", 201, 202)
    assert run() == {"movies_metadata": 66, "reviews": 66, "credits": 63}


def test_profile_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "a int, b string")
    row = table_profile(df, "t").first()
    assert (row.row_count, row.col_count, row.columns, row.null_counts) == (3, 2, ["a", "b"], {"a": 1, "b": 2})


def test_observed_rows(spark):
    from pyspark.sql import Observation
    seen = Observation("rows")
    df = audited(spark.range(7), seen, F.max("id").alias("largest"))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7, "largest": 6}


def test_ingest_lands_only_new_choices(spark, tmp_path):
    lines = [json.dumps(record(i)) for i in range(1, 9)] + [json.dumps(record(3, media_type="tv", title="Series"))]
    (tmp_path / "d.json").write_text("\n".join(lines))
    details = read_landing(spark, str(tmp_path / "d.json"))
    listing = details.withColumns({
        "genre_ids": F.array(F.when(F.col("media_type") == "tv", 18).otherwise(28)), "keyword_ids": F.array(F.lit(0)),
        "trending_rank": F.lit(None).cast("int"), "vote_count": F.lit(700), "first_air_date": F.col("release_date")})
    bronze = str(tmp_path / "bronze")
    first = L.ingest(listing, details, bronze, 3)
    assert [(r.id, r.stage) for r in first.orderBy("position").collect()] == [(8, 1), (7, 1), (6, 1)]
    second = L.ingest(listing, details, bronze, 100)
    assert {r.id for r in second.collect()} == {1, 2, 3, 4, 5}
    assert L.ingest(listing, details, bronze, 100).count() == 0
    titles = read_text_table(spark, f"{bronze}/movies_metadata", BRONZE["movies_metadata"])
    assert sorted(int(r.id) for r in titles.collect()) == list(range(1, 9))
    assert titles.where("media_type = 'tv'").count() == 0


def test_ingest_by_kind_and_id_takes_a_series_with_a_movies_id(spark, tmp_path):
    lines = [json.dumps(record(i)) for i in (1, 2, 3)] + [json.dumps(record(3, media_type="tv", title="Series"))]
    (tmp_path / "d.json").write_text("\n".join(lines))
    details = read_landing(spark, str(tmp_path / "d.json"))
    listing = details.withColumns({
        "genre_ids": F.array(F.when(F.col("media_type") == "tv", 18).otherwise(28)), "keyword_ids": F.array(F.lit(0)),
        "trending_rank": F.lit(None).cast("int"), "vote_count": F.lit(700), "first_air_date": F.col("release_date")})
    bronze, both = str(tmp_path / "bronze"), ["media_type", "id"]
    first = L.ingest(listing, details, bronze, 2, by=both)
    assert {(r.media_type, r.id) for r in first.collect()} == {("movie", 3), ("movie", 2)}
    second = L.ingest(listing, details, bronze, 100, by=both)
    assert {(r.media_type, r.id) for r in second.collect()} == {("movie", 1), ("tv", 3)}
    assert L.ingest(listing, details, bronze, 100, by=both).count() == 0
    assert read_text_table(spark, f"{bronze}/movies_metadata", BRONZE["movies_metadata"]).count() == 4


def test_plain_csv_files_are_bronze_too(spark, tmp_path):
    (tmp_path / "keywords.csv").write_text('id,keywords\n7,"[{""name"": ""old""}]"\n8,[]\n')
    path = f"{tmp_path}/keywords"
    new = spark.createDataFrame([("7", "[]"), ("9", '[{"name":"n"}]')], "id string, keywords string")
    with pytest.raises(ValueError):
        append_batch(new.select("keywords", "id"), path)
    assert {r.id for r in known_keys(spark, path, BRONZE["keywords"], "id").collect()} == {"7", "8"}
    append_batch(new, path, key="id")
    assert {r.id for r in known_keys(spark, path, BRONZE["keywords"], "id").collect()} == {"7", "8", "9"}
    bronze = L.read_bronze(spark, str(tmp_path))
    assert [n for n, df in bronze.items() if df is not None] == ["keywords"]
    assert {tuple(r)[::2] for r in L.silver_keywords(bronze["keywords"]).collect()} == {(7, "old"), (8, ""), (9, "n")}
