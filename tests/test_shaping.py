import json

from lakeloom.operators import shaping as R
from lakeloom.sources.readers import read_landing
from lakeloom.sources.schemas import BRONZE, LANDING


def landed(spark, *records):
    lines = spark.sparkContext.parallelize([json.dumps(r) for r in records])
    return spark.read.schema(LANDING).json(lines)


def by_id(df, key="id"):
    return {r[key]: r for r in df.collect()}


MOVIE = {
    "id": 1, "title": "", "name": "Named", "overview": "text", "media_type": "movie", "release_date": "",
    "first_air_date": "2001-02-03", "imdb_id": "", "runtime": None, "vote_average": 7.5, "budget": 5,
    "genres": [{"id": 18, "name": "Drama", "more": {"x": [1, None]}}], "credits": {
        "cast": [{"name": f"c{i}"} for i in range(12)],
        "crew": [{"name": f"e{i}", "job": "Editor"} for i in range(3)]
        + [{"name": f"d{i}", "job": "Director"} for i in range(14)]},
    "keywords": {"keywords": [], "results": [{"name": "k"}]},
    "reviews": {"results": [
        {"id": "r1", "content": "  " + "a" * 31 + "\r\nb ", "author_details": {"rating": 0}},
        {"content": "b" * 30}, {"content": "c" * 29 + "\n\n", "author_details": {"rating": 3}},
        {"id": "r4", "content": "d" * 99}]},
}
SERIES = {"id": 2, "title": "S", "media_type": "tv", "episode_run_time": [], "imdb_id": "tt77"}
EMPTY = {"id": 3, "media_type": "tv"}


def test_columns_match_the_bronze_tables(spark):
    for name, df in R.bronze_rows(landed(spark, MOVIE)).items():
        assert df.columns == BRONZE[name]
        assert {t for _, t in df.dtypes} == {"string"}


def test_metadata(spark):
    rows = by_id(R.metadata_rows(landed(spark, MOVIE, SERIES)))
    movie, series = rows["1"], rows["2"]
    assert (movie.title, movie.release_date, movie.imdb_id, movie.runtime) == ("Named", "2001-02-03", "tt1", "0")
    assert (json.loads(movie.genres), movie.spoken_languages, movie.budget, movie.vote_average) == (MOVIE["genres"], "[]", "5", "7.5")
    assert (series.runtime, series.original_language, series.status, series.popularity) == ("45", "en", "Released", "0.0")


def test_records_without_a_name_are_rejected(spark):
    assert [r.id for r in R.has_identity(landed(spark, MOVIE, EMPTY)).collect()] == [1]


def test_rejected_records_are_counted(spark, tmp_path):
    (tmp_path / "x.json").write_text("\n".join([json.dumps(MOVIE), json.dumps(EMPTY), '{"id": 4, "title"', '{"title": "t"}',
                                                '{"id": 5, "title": "t", "budget": "12.5", "genres": [null, 3]}']))
    landed = read_landing(spark, str(tmp_path / "x.json"))
    counts = {r.reason: r.records for r in R.landing_rejects(landed).collect()}
    assert counts == {"landed": 2, "no title": 1, "broken": 1, "no id": 1}
    row = R.metadata_rows(landed.where("id = 5")).first()
    assert (row.budget, row.genres) == ("12.5", "[null,3]")


def test_credits(spark):
    row = R.credit_rows(landed(spark, MOVIE)).first()
    assert [c["name"] for c in json.loads(row.cast)] == [f"c{i}" for i in range(10)]
    assert [c["name"] for c in json.loads(row.crew)] == [f"d{i}" for i in range(12)]
    assert R.credit_rows(landed(spark, SERIES)).first()[1:] == ("[]", "[]")


def test_keywords(spark):
    rows = by_id(R.keyword_rows(landed(spark, MOVIE, SERIES)))
    assert (json.loads(rows["1"].keywords), rows["2"].keywords) == ([{"name": "k"}], "[]")


def test_links_and_seed_ratings(spark):
    assert {tuple(r) for r in R.link_rows(landed(spark, MOVIE, SERIES)).collect()} == {("1", "", "1"), ("2", "77", "2")}
    assert {tuple(r) for r in R.rating_rows(landed(spark, MOVIE, SERIES)).collect()} == {
        ("1", "1", "7.5", "1600000000"), ("1", "2", "7.0", "1600000000")}


def test_reviews_are_cut_before_they_are_tested(spark):
    rows = [tuple(r) for r in R.review_rows(landed(spark, MOVIE)).collect()]
    assert rows == [("r1", "1", "Named", "a" * 31 + " b", "positive", "7.0")]
    short = R.review_rows(landed(spark, MOVIE), longer_than=20, flatten_first=True).collect()
    assert [(r.review_id, r.sentiment, r.rating) for r in short] == [
        ("r1", "positive", "7.0"), ("r_1", "positive", "7.0"), ("r_1", "negative", "3.0")]
