import random

import pytest

from lakeloom.operators import presets as P
from lakeloom.operators import selection as S
from lakeloom.plans.acquire import acquire, stage_keys


def flags(spark, data, schema, expression):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_year_range(spark):
    dates = ["1969-12-31", "1970-01-01", "2026-12-31", "2027-01-01", "", None, "abcd-01-01", "197"]
    assert flags(spark, [(d,) for d in dates], "d string", S.year_in_range("d", 1970, 2026)) == [
        False, True, True, False, True, True, True, True]


def test_presence(spark):
    data = [("p", "x" * 19), ("p", "x" * 20), ("", "x" * 20), (None, "x" * 20), ("p", None)]
    assert flags(spark, data, "p string, o string", S.is_presentable("p", "o")) == [False, True, False, False, False]


def test_thresholds(spark):
    data = [("en", 39, 499), ("en", 39, 500), ("en", 40, 0), ("ko", 29, 4), ("ko", 29, 5), ("ko", 30, 0), (None, None, None)]
    assert flags(spark, data, "l string, r int, v int", S.meets_threshold("l", "r", "v")) == [
        False, True, True, False, True, True, False]


def test_selector_without_criteria_keeps_everything(spark, sf):
    part = sf("part")
    assert S.select_catalogue(part).count() == part.count()


def test_preset_shapes():
    keys = stage_keys(1970, 2026)
    per_stage = {s: sum(k.stage == s for k in keys) for s in range(1, 11)}
    assert per_stage == {1: 19, 2: 11, 3: 10, 4: 3, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1, 10: 5}
    assert len(P.TV_GENRES) == 16


def one_by_one(listing, target, existing, languages, per_key_limit):
    """The stages as a loop over single items."""
    def date_ok(d, a, b):
        return f"{a}-01-01" <= d <= f"{b}-12-31"

    movie = lambda r: r["media_type"] == "movie"
    year = lambda r: date_ok(r["release_date"], *P.YEARS)
    keys = [(1, lambda r, c=c: movie(r) and c in r["genre_ids"] and r["vote_count"] >= 25 and year(r), "popularity")
            for c in P.MOVIE_GENRES.values()]
    keys += [(2, lambda r, c=c: movie(r) and c in r["keyword_ids"] and r["vote_count"] >= 20, "vote_count")
             for c in P.KEYWORD_IDS.values()]
    regions = [r for r in P.REGIONS if r[1] in languages]
    keys += [(3, lambda r, c=c, m=m: movie(r) and r["original_language"] == c and r["vote_count"] >= m, "vote_count")
             for _, c, m in regions]
    keys += [(4, lambda r, a=a, b=b: movie(r) and date_ok(r["release_date"], a, b) and r["vote_count"] >= 30, "vote_count")
             for a, b in P.ERAS]
    keys += [(5, lambda r: movie(r) and year(r) and r["vote_count"] >= 30, "popularity"),
             (6, lambda r: movie(r) and year(r) and r["vote_count"] >= 60, "vote_count"),
             (7, lambda r: movie(r) and r["trending_rank"] is not None, "trending"),
             (8, lambda r: movie(r) and year(r) and r["vote_average"] >= 7.8 and r["vote_count"] >= 15, "popularity"),
             (9, lambda r: movie(r) and 16 in r["genre_ids"] and r["original_language"] == "ja" and r["vote_count"] >= 15,
              "popularity")]
    keys += [(10, lambda r, c=P.TV_GENRES[n]: r["media_type"] == "tv" and c in r["genre_ids"] and r["vote_count"] >= 25
              and date_ok(r["first_air_date"], *P.YEARS), "popularity") for n in P.TV_STAGE_GENRES]

    def accepted(r):
        d = r["release_date"] or r["first_air_date"]
        if not P.YEARS[0] <= int(d[:4]) <= P.YEARS[1] or not r["poster_path"] or len(r["overview"]) < 20:
            return False
        if r["media_type"] == "tv":
            return True
        least = (40, 500) if r["original_language"] == "en" else (30, 5)
        return r["runtime"] >= least[0] or r["vote_count"] >= least[1]

    quota = max(5, target // len(regions))
    seen, out = set(existing), []
    for stage, member, sort in keys:
        size = lambda r: -r["trending_rank"] if sort == "trending" else r[sort]  # noqa: B023, E731
        page = sorted((r for r in listing if member(r)), key=lambda r: (-size(r), r["id"]))[:per_key_limit]
        taken = 0
        for r in page:
            if stage == 3 and taken >= quota:
                break
            if r["id"] in seen or not accepted(r):
                continue
            seen.add(r["id"])
            taken += 1
            out.append((r["id"], stage))
    return out[:target]


@pytest.mark.parametrize("seed, target, limit", [(1, 60, None), (2, 400, None), (3, 150, 12), (4, 30, 3)])
def test_acquire_equals_the_loop(spark, seed, target, limit):
    rng = random.Random(seed)
    genres = list(P.MOVIE_GENRES.values())[:4] + [10759, 10765]
    listing = [{
        "id": i, "media_type": rng.choice(["movie", "movie", "movie", "tv"]),
        "genre_ids": rng.sample(genres, rng.randint(0, 2)), "keyword_ids": rng.sample([9715, 12190, 5], rng.randint(0, 1)),
        "original_language": rng.choice(["en", "ja", "ja", "fr"]), "release_date": f"{rng.randint(1960, 2030)}-05-05",
        "first_air_date": f"{rng.randint(1960, 2030)}-05-05", "vote_count": rng.choice([0, 3, 16, 22, 40, 70, 600]),
        "vote_average": rng.choice([5.0, 7.8, 9.0]), "popularity": float(rng.randint(0, 20)),
        "trending_rank": rng.choice([None, None, None, i]), "overview": "o" * rng.choice([19, 20, 40, 40]),
        "poster_path": rng.choice(["p", "p", "p", ""]), "runtime": rng.choice([20, 35, 90, 90])} for i in range(400)]
    schema = ("id long, media_type string, genre_ids array<int>, keyword_ids array<int>, original_language string, "
              "release_date string, first_air_date string, vote_count int, vote_average double, popularity double, "
              "trending_rank int, overview string, poster_path string, runtime int")
    columns = [c.split()[0] for c in schema.split(", ")]
    df = spark.createDataFrame([tuple(r[c] for c in columns) for r in listing], schema)
    known = [r["id"] for r in listing if rng.random() < 0.1]
    existing = spark.createDataFrame([(i,) for i in known], "id long")
    out = acquire(df, target, existing=existing, languages=["ja", "fr"], per_key_limit=limit)
    got = [(r.id, r.stage) for r in out.orderBy("position").collect()]
    assert got == one_by_one(listing, target, known, ["ja", "fr"], limit)


def test_acquire_one_group_only(spark):
    df = spark.createDataFrame(
        [(1, "movie", [28], [9715], "en", "2000-01-01", "", 600, 8.0, 1.0, None, "o" * 30, "p", 90)],
        "id long, media_type string, genre_ids array<int>, keyword_ids array<int>, original_language string, "
        "release_date string, first_air_date string, vote_count int, vote_average double, popularity double, "
        "trending_rank int, overview string, poster_path string, runtime int")
    assert [(r.stage, r.key) for r in acquire(df, 5, groups=["keywords"]).collect()] == [(2, "superhero")]
    assert [(r.stage, r.key) for r in acquire(df, 5, groups=["streams"]).collect()] == [(5, "popular")]
    assert acquire(df, 5, groups=["genres"], genres=["drama"]).count() == 0


def test_ids_of_movies_and_series(spark):
    row = (1, "movie", [28, 18], [], "en", "2000-01-01", "2000-01-01", 600, 8.0, 1.0, None, "o" * 30, "p", 90)
    df = spark.createDataFrame(
        [row, (1, "tv", *row[2:])],
        "id long, media_type string, genre_ids array<int>, keyword_ids array<int>, original_language string, "
        "release_date string, first_air_date string, vote_count int, vote_average double, popularity double, "
        "trending_rank int, overview string, poster_path string, runtime int")
    assert [(r.id, r.stage) for r in acquire(df, 5).collect()] == [(1, 1)]
    apart = acquire(df, 5, by=["media_type", "id"]).orderBy("position").collect()
    assert [(r.media_type, r.stage, r.key) for r in apart] == [("movie", 1, "action"), ("tv", 10, "drama")]
