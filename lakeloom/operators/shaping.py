"""Nested detail records to the six Bronze tables.

All outputs are text. They are narrow projections of the landing records, so
the six tables cost one pass each over the columns they need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.nested import first_n, first_text, objects_json
from lakeloom.functions.score import DEFAULT_RATING, sentiment_label
from lakeloom.functions.text import strip
from lakeloom.operators.presets import CREW_JOBS
from lakeloom.sources.schemas import CORRUPT

# Default runtime of a series, list lengths, seed user and seed time.
SERIES_RUNTIME = 45
CAST_LIMIT = 10
CREW_LIMIT = 12
REVIEW_LIMIT = 3
SEED_USER = "1"
SEED_TIME = "1600000000"


def has_identity(df: DataFrame) -> DataFrame:
    """Records with an id and a title or name; a failed fetch has neither."""
    return df.where(F.col("id").isNotNull() & (first_text("title", "name") != ""))


def landing_rejects(df: DataFrame) -> DataFrame:
    """(reason, records): landed records, and those that ``has_identity`` leaves out, by what they lack."""
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    reason = (F.when(broken, "broken").when(F.col("id").isNull(), "no id")
              .when(first_text("title", "name") == "", "no title").otherwise("landed"))
    return df.groupBy(reason.alias("reason")).agg(F.count("*").alias("records"))


def runtime(movie_default: int | None = 0) -> Column:
    """Minutes of a movie, or of the first episode length of a series."""
    series = F.coalesce(F.try_element_at("episode_run_time", F.lit(1)), F.lit(SERIES_RUNTIME))
    return F.when(F.col("media_type") == "tv", series).otherwise(
        F.coalesce(F.col("runtime").try_cast("int"), F.lit(movie_default)))


def _text(c: str, default: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(default))


def metadata_rows(df: DataFrame) -> DataFrame:
    """One 21-column text row per record."""
    key = F.col("id").cast("string")
    return df.select(
        key.alias("id"),
        first_text("title", "name").alias("title"),
        first_text("original_title", "original_name").alias("original_title"),
        _text("overview", "").alias("overview"),
        objects_json("genres").alias("genres"),
        _text("budget", "0").alias("budget"),
        _text("revenue", "0").alias("revenue"),
        first_text("release_date", "first_air_date").alias("release_date"),
        runtime().cast("string").alias("runtime"),
        _text("popularity", "0.0").alias("popularity"),
        _text("vote_average", "0.0").alias("vote_average"),
        _text("vote_count", "0").alias("vote_count"),
        _text("poster_path", "").alias("poster_path"),
        first_text("imdb_id", F.concat(F.lit("tt"), key)).alias("imdb_id"),
        _text("original_language", "en").alias("original_language"),
        _text("status", "Released").alias("status"),
        _text("tagline", "").alias("tagline"),
        F.col("media_type"),
        objects_json("production_companies").alias("production_companies"),
        objects_json("production_countries").alias("production_countries"),
        objects_json("spoken_languages").alias("spoken_languages"),
    )


def credit_rows(df: DataFrame) -> DataFrame:
    """R2: the first cast members, and the first crew members with a key job."""
    crew = F.filter("credits.crew", lambda c: F.coalesce(F.get_json_object(c, "$.job").isin(*CREW_JOBS), F.lit(False)))
    return df.select(
        F.col("id").cast("string").alias("id"),
        objects_json(F.slice("credits.cast", 1, CAST_LIMIT)).alias("cast"),
        objects_json(F.slice(crew, 1, CREW_LIMIT)).alias("crew"),
    )


def keyword_rows(df: DataFrame) -> DataFrame:
    """The movie keyword list, or the series one when the first is empty."""
    movie, series = F.col("keywords.keywords"), F.col("keywords.results")
    chosen = F.when(F.coalesce(F.size(movie), F.lit(0)) > 0, movie).otherwise(series)
    return df.select(F.col("id").cast("string").alias("id"), objects_json(chosen).alias("keywords"))


def link_rows(df: DataFrame) -> DataFrame:
    """External ids, the imdb id without its 'tt'."""
    key = F.col("id").cast("string")
    return df.select(
        key.alias("movieId"),
        F.replace(_text("imdb_id", ""), F.lit("tt"), F.lit("")).alias("imdbId"),
        key.alias("tmdbId"),
    )


def rating_rows(df: DataFrame) -> DataFrame:
    """One seed rating per record."""
    return df.select(
        F.lit(SEED_USER).alias("userId"),
        F.col("id").cast("string").alias("movieId"),
        _text("vote_average", str(DEFAULT_RATING)).alias("rating"),
        F.lit(SEED_TIME).alias("timestamp"),
    )


def one_line(c: Column | str) -> Column:
    """Line feeds become blanks and carriage returns vanish."""
    return F.translate(c, "\n\r", " ")


def review_rows(df: DataFrame, longer_than: int = 30, flatten_first: bool = False) -> DataFrame:
    """R6+P10: the usable ones among the first three reviews of each record.

    The list is cut to three before the length test. ``flatten_first`` removes
    line breaks before the test, as the on-demand path does. A missing or zero
    rating becomes the default.
    """
    title = first_text("title", "name")
    reviews = df.select("id", title.alias("movie_title"),
                        F.explode(first_n("reviews.results", REVIEW_LIMIT)).alias("r"))
    body = strip(F.coalesce("r.content", F.lit("")))
    tested = one_line(body) if flatten_first else body
    given = F.col("r.author_details.rating")
    rating = F.when(given != 0, given).otherwise(F.lit(DEFAULT_RATING))
    key = F.col("id").cast("string")
    return reviews.where(F.length(tested) > longer_than).select(
        F.coalesce("r.id", F.concat(F.lit("r_"), key)).alias("review_id"),
        key.alias("movieId"),
        "movie_title",
        one_line(body).alias("review_text"),
        sentiment_label(rating).alias("sentiment"),
        rating.cast("string").alias("rating"),
    )


def bronze_rows(df: DataFrame) -> dict[str, DataFrame]:
    """All six Bronze tables of a set of landing records."""
    df = has_identity(df)
    return {
        "movies_metadata": metadata_rows(df),
        "credits": credit_rows(df),
        "keywords": keyword_rows(df),
        "links": link_rows(df),
        "ratings": rating_rows(df),
        "reviews": review_rows(df),
    }
