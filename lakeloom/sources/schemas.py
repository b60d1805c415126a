"""Schemas of the landing records and of the Bronze tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Bronze columns in file order, every cell text.
BRONZE = {
    "movies_metadata": [
        "id", "title", "original_title", "overview", "genres", "budget", "revenue",
        "release_date", "runtime", "popularity", "vote_average", "vote_count",
        "poster_path", "imdb_id", "original_language", "status", "tagline",
        "media_type", "production_companies", "production_countries", "spoken_languages",
    ],
    "credits": ["id", "cast", "crew"],
    "keywords": ["id", "keywords"],
    "links": ["movieId", "imdbId", "tmdbId"],
    "ratings": ["userId", "movieId", "rating", "timestamp"],
    "reviews": ["review_id", "movieId", "movie_title", "review_text", "sentiment", "rating"],
}

# The objects of a list keep all their fields: each one is landed as its own JSON text.
OBJECTS = T.ArrayType(T.StringType())
CORRUPT = "_corrupt_record"
_REVIEW = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("author_details", T.StructType([T.StructField("rating", T.DoubleType())])),
])

LANDING = T.StructType(
    [T.StructField("id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in (
        "title", "name", "original_title", "original_name", "overview", "poster_path", "imdb_id",
        "original_language", "release_date", "first_air_date",
        # Numbers stay the text they were landed as, quoted or not.
        "runtime", "budget", "revenue", "popularity", "vote_average", "vote_count",
        "status", "tagline", "media_type")]
    + [T.StructField("episode_run_time", T.ArrayType(T.IntegerType())),
       T.StructField("genres", OBJECTS),
       T.StructField("production_companies", OBJECTS),
       T.StructField("production_countries", OBJECTS),
       T.StructField("spoken_languages", OBJECTS),
       T.StructField("credits", T.StructType([
           T.StructField("cast", OBJECTS), T.StructField("crew", OBJECTS)])),
       T.StructField("keywords", T.StructType([
           T.StructField("keywords", OBJECTS), T.StructField("results", OBJECTS)])),
       T.StructField("reviews", T.StructType([T.StructField("results", T.ArrayType(_REVIEW))])),
       # The text of a line that is no JSON object.
       T.StructField(CORRUPT, T.StringType()),
       ])


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
