"""Staged selection of new catalogue items.

Ten stages claim items in priority order, each stage through one or more keys.
An item belongs to the first stage that may take it, except that a region
takes only its quota and leaves the rest to later stages. All of that is one
pass: every row lists the keys it matches and keeps the first one before, in
and after the region stage, one aggregate merges the rows of an id, and only
the quota winners (a bounded set) are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import presets as P
from lakeloom.operators.relational import WINDOW_PRUNE_LIMIT, exclude_existing, first_per_group, group_quota, top_per_group
from lakeloom.operators.selection import is_acceptable

GROUPS = {"genres": (1,), "keywords": (2,), "regions": (3,), "eras": (4,), "streams": (5, 6, 7, 8, 9, 10)}
REGION_STAGE = 3
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Key:
    """One listing: who belongs to it and how it is sorted (highest first)."""

    stage: int
    name: str
    member: Column
    sort: Column


def movie_genre_ids(names: Sequence[str] | None) -> list[tuple[str, int]]:
    """J3 for the selector's own arguments: genre name or number; unknown names are skipped."""
    out = []
    for name in names or list(P.MOVIE_GENRES):
        try:
            out.append((name, P.MOVIE_GENRES.get(name.lower().strip()) or int(name)))
        except ValueError:
            continue
    return out


def stage_keys(start: int, end: int, genres: Sequence[str] | None = None,
               keywords: dict[str, int] | None = None,
               languages: Sequence[str] | None = None) -> list[Key]:
    """The keys of the ten stages, in order, over a listing with landing column names."""
    movie, series = F.col("media_type") == "movie", F.col("media_type") == "tv"
    votes, rating, popularity = F.col("vote_count"), F.col("vote_average"), F.col("popularity")

    def released(first: int, last: int, c: str = "release_date") -> Column:
        return F.col(c).between(f"{first}-01-01", f"{last}-12-31")

    in_range = released(start, end)
    keys = [Key(1, name, movie & F.array_contains("genre_ids", code) & (votes >= P.GENRE_VOTES) & in_range,
                popularity) for name, code in movie_genre_ids(genres)]
    keys += [Key(2, name, movie & F.array_contains("keyword_ids", code) & (votes >= P.KEYWORD_VOTES), votes)
             for name, code in (P.KEYWORD_IDS if keywords is None else keywords).items()]
    keys += [Key(3, code, movie & (F.col("original_language") == code) & (votes >= least), votes)
             for _, code, least in P.REGIONS if not languages or code in languages]
    keys += [Key(4, f"{first}-{last}", movie & released(first, last) & (votes >= P.ERA_VOTES), votes)
             for first, last in P.ERAS]
    keys += [
        Key(5, "popular", movie & in_range & (votes >= P.POPULAR_VOTES), popularity),
        Key(6, "classics", movie & in_range & (votes >= P.CLASSIC_VOTES), votes),
        Key(7, "trending", movie & F.col("trending_rank").isNotNull(), -F.col("trending_rank")),
        Key(8, "cult", movie & in_range & (rating >= P.CULT_RATING) & (votes >= P.CULT_VOTES), popularity),
        Key(9, "anime", movie & F.array_contains("genre_ids", P.MOVIE_GENRES["animation"])
            & (F.col("original_language") == "ja") & (votes >= P.ANIME_VOTES), popularity),
    ]
    keys += [Key(10, name, series & F.array_contains("genre_ids", P.TV_GENRES[name]) & (votes >= P.TV_VOTES)
                 & released(start, end, "first_air_date"), popularity) for name in P.TV_STAGE_GENRES]
    return keys


def acquire(listing: DataFrame, target: int, *, existing: DataFrame | None = None,
            groups: Sequence[str] | None = None, start: int = P.YEARS[0], end: int = P.YEARS[1],
            genres: Sequence[str] | None = None, keywords: dict[str, int] | None = None,
            languages: Sequence[str] | None = None, per_key_limit: int | None = None,
            by: Sequence[str] = ("id",)) -> DataFrame:
    """Choose up to ``target`` new items: (*by, stage, key, position) in priority order.

    ``listing`` has the landing columns plus ``genre_ids``, ``keyword_ids`` and
    ``trending_rank``. ``per_key_limit`` reads only the first rows of every
    key's listing. ``position`` is the place in the result. Movies and series
    share their ids unless ``by`` is ("media_type", "id").
    """
    stages = [s for g in (groups or GROUPS) for s in GROUPS[g]]
    keys = [k for k in stage_keys(start, end, genres, keywords, languages) if k.stage in stages]
    by = list(by)
    # Ordered by key, then best first within a key.
    matches = F.array(*[
        F.when(k.member, F.struct(F.lit(n).alias("key_no"), (-k.sort.cast("double")).alias("after_best")))
        for n, k in enumerate(keys)])
    first_region = sum(k.stage < REGION_STAGE for k in keys)
    region_keys = sum(k.stage == REGION_STAGE for k in keys)
    zones = {"before": lambda m: m["key_no"] < first_region,
             "region": lambda m: m["key_no"].between(first_region, first_region + region_keys - 1),
             "after": lambda m: m["key_no"] >= first_region + region_keys}
    rows = listing.select(*by, is_acceptable(start, end).alias("accepted"),
                          F.filter(matches, lambda m: m.isNotNull()).alias("m"))
    if per_key_limit is None:
        rows = rows.where("accepted").select(*by, *[
            F.try_element_at(F.filter("m", zone), F.lit(1)).alias(z) for z, zone in zones.items()])
    else:
        claims = rows.select(*by, "accepted", F.explode("m").alias("m")).withColumn("key_no", F.col("m.key_no"))
        claims = top_per_group(claims, ["key_no"], [F.asc("m.after_best"), *[F.asc(c) for c in by[::-1]]],
                               per_key_limit, "_place")
        rows = claims.where("accepted").select(*by, *[F.when(zone(F.col("m")), F.col("m")).alias(z)
                                                      for z, zone in zones.items()])
    if existing is not None:
        rows = exclude_existing(rows, existing, by)
    per_item = rows.groupBy(*by).agg(*[F.min(z).alias(z) for z in zones])

    choice = F.coalesce("before", "after")
    if region_keys:
        quota = group_quota(target, region_keys)
        waiting = per_item.where("before is null and region is not null").select(*by, "region.*")
        order = [F.asc("after_best"), *[F.asc(c) for c in by[::-1]]]
        winners = first_per_group(waiting, ["key_no"], "after_best", quota, order[1:], rank="_place")
        won = winners.select(*by, F.lit(True).alias("won"))
        # At most quota x regions rows, both fixed by the arguments.
        small = quota * region_keys <= BROADCAST_ROWS
        per_item = per_item.join(F.broadcast(won) if small else won, by, "left")
        choice = F.coalesce("before", F.when(F.col("won"), F.col("region")), "after")
    order = ["key_no", "after_best", *by[::-1]]
    chosen = per_item.select(*by, choice.alias("c")).where("c is not null").select(*by, "c.*")
    if target <= WINDOW_PRUNE_LIMIT:
        chosen = chosen.orderBy(*order).limit(target)
    # The first rows of one order over everything, counted over ranges where they are many.
    chosen = top_per_group(chosen, [], [F.asc(c) for c in order], target, "position")
    stage_of = F.array(*[F.lit(k.stage) for k in keys])
    name_of = F.array(*[F.lit(k.name) for k in keys])
    return chosen.select(*by, F.get(stage_of, "key_no").cast("bigint").alias("stage"),
                         F.get(name_of, "key_no").alias("key"), "position")
