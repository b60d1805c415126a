"""Row predicates and catalogue selectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.common import as_column
from lakeloom.functions.nested import first_text


def year_in_range(date: Column | str, start: int, end: int) -> Column:
    """P5: false only when the first four characters are a year outside the range."""
    date = F.coalesce(as_column(date), F.lit(""))
    year = F.substring(date, 1, 4).try_cast("int")
    return (F.length(date) < 4) | F.coalesce(year.between(start, end), F.lit(True))


def is_presentable(poster: Column | str, overview: Column | str, min_length: int = 20) -> Column:
    """Has a poster and an overview of at least ``min_length`` characters."""
    return ((F.coalesce(as_column(poster), F.lit("")) != "")
            & (F.length(F.coalesce(as_column(overview), F.lit(""))) >= min_length))


def meets_threshold(language: Column | str, length: Column | str, votes: Column | str,
                    home_language: str = "en", home: tuple[float, float] = (40, 500),
                    other: tuple[float, float] = (30, 5)) -> Column:
    """Long enough or voted on enough, with one (length, votes) pair for the home language."""
    length = F.coalesce(as_column(length), F.lit(0))
    votes = F.coalesce(as_column(votes), F.lit(0))
    at_home = F.coalesce(as_column(language), F.lit(home_language)) == home_language
    return (F.when(at_home, (length >= home[0]) | (votes >= home[1]))
            .otherwise((length >= other[0]) | (votes >= other[1])))


def release_text(release: Column | str = "release_date", air: Column | str = "first_air_date") -> Column:
    """Release date text, else first air date, else empty."""
    return first_text(release, air)


def is_acceptable(start: int, end: int) -> Column:
    """P5-P7 over a listing with the landing column names; only movies have a threshold."""
    return (year_in_range(release_text(), start, end)
            & is_presentable("poster_path", "overview")
            & ((F.col("media_type") == "tv")
               | meets_threshold("original_language", "runtime", "vote_count")))


def select_catalogue(df: DataFrame, *, genre: int | None = None, keyword: int | None = None,
                     languages: Sequence[str] = (), min_votes: float | None = None,
                     min_rating: float | None = None, released: tuple[str, str] | None = None,
                     order: Sequence[Column] = (), columns: dict[str, str] | None = None) -> DataFrame:
    """Conjunctive selector over a listing; an absent criterion selects everything.

    ``columns`` maps the roles genres, keywords, language, votes, rating and
    date to the column names of the listing.
    """
    names = {"genres": "genre_ids", "keywords": "keyword_ids", "language": "original_language",
             "votes": "vote_count", "rating": "vote_average", "date": "release_date", **(columns or {})}
    rules = []
    if genre is not None:
        rules.append(F.array_contains(names["genres"], genre))
    if keyword is not None:
        rules.append(F.array_contains(names["keywords"], keyword))
    if languages:
        rules.append(F.col(names["language"]).isin(*languages))
    if min_votes is not None:
        rules.append(F.col(names["votes"]) >= min_votes)
    if min_rating is not None:
        rules.append(F.col(names["rating"]) >= min_rating)
    if released is not None:
        rules.append(F.col(names["date"]).between(*released))
    for rule in rules:
        df = df.where(rule)
    return df.orderBy(*order) if order else df
