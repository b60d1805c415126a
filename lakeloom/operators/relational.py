"""Deduplication, unions, joins, quotas and arg-max."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.functions.text import strip
from lakeloom.session import materialise

# Spark's default for spark.sql.optimizer.windowGroupLimitThreshold.
WINDOW_PRUNE_LIMIT = 1000
#: Bins of a histogram that narrows down the n-th value of a group, and how often it is refined at most.
BINS, REFINEMENTS = 256, 6
#: Pairs of rows without a key that one join task may make.
NULL_PAIRS = 10_000_000
#: Keys up to which a lookup is pushed into the scan as values.
PUSHED_KEYS = 300


class FanOut(ValueError):
    """Rows without a key would match each other too often."""


def keep_first(df: DataFrame, keys: Sequence[str], order: str | Column) -> DataFrame:
    """The first row of every key by ``order``, which must be unique per key.

    NULL keys equal each other. A hot key is cut to one row per task before
    anything is shuffled.
    """
    order = F.col(order) if isinstance(order, str) else order
    return top_per_group(df, keys, [order.asc()], 1, "_place").drop("_place")


def exclude_existing(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold yet."""
    return df.join(existing.select(*keys), list(keys), "left_anti")


def first_wins_union(stages: Sequence[DataFrame], keys: Sequence[str], position: str,
                     existing: DataFrame | None = None, cap: int | None = None) -> DataFrame:
    """D2+F4: union candidate tables in priority order, each key from the first stage that has it.

    ``position`` ranks the rows of one stage. The result holds ``stage`` (1-based)
    and is cut to ``cap`` rows in (stage, position, key) order.
    """
    tagged = [s.withColumn("stage", F.lit(i).cast("bigint")) for i, s in enumerate(stages, 1)]
    union = reduce(lambda a, b: a.unionByName(b), tagged)
    if existing is not None:
        union = exclude_existing(union, existing, keys)
    chosen = keep_first(union, keys, F.struct("stage", position))
    return chosen if cap is None else chosen.orderBy("stage", position, *keys).limit(cap)


def null_pairs(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> tuple[int, int]:
    """Rows without a key on both sides of a join: every one of them matches every other."""
    return tuple(df.where(F.col(k).isNull()).count() for df, k in ((left, left_key), (right, right_key or left_key)))


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
              null_safe: bool = True, max_pairs: int | None = None, on_excess: str = "split") -> DataFrame:
    """Left outer join on one key; with ``null_safe`` a NULL key finds NULL keys.

    The right key column is dropped; Spark picks the join strategy. NULL keys
    are one hot key whose rows pair n x m. With ``max_pairs`` they are counted
    first: beyond it the join is refused (``on_excess="raise"``) or those pairs
    are dealt to so many tasks that none makes more than ``max_pairs``.
    """
    right_key = right_key or left_key
    renamed = right.withColumnRenamed(right_key, "_right_key")
    if null_safe and max_pairs is not None:
        lefts, rights = null_pairs(left, right, left_key, right_key)
        if lefts * rights > max_pairs:
            if on_excess == "raise":
                raise FanOut(f"{lefts} x {rights} rows without {left_key} match each other; the bound is {max_pairs}")
            return _split_nulls(left, renamed, left_key, lefts, rights, max_pairs)
    condition = (F.col(left_key).eqNullSafe(F.col("_right_key")) if null_safe
                 else F.col(left_key) == F.col("_right_key"))
    return left.join(renamed, condition, "left").drop("_right_key")


def _split_nulls(left: DataFrame, right: DataFrame, key: str, lefts: int, rights: int, max_pairs: int) -> DataFrame:
    """Left join in which the rows without a key, ``lefts`` and ``rights`` of them, are dealt to a grid of tasks.

    Both sides are cut, so that a part of the left meets a part of the right in
    ``max_pairs`` pairs or fewer, but for the chance by which rows fall to parts.
    A row is copied once for every part of the other side.
    """
    found = (left.where(F.col(key).isNotNull()).join(right.where("_right_key is not null"), F.col(key) == F.col("_right_key"), "left")
             .drop("_right_key"))
    rows, columns = _grid(lefts, rights, max_pairs)

    def dealt(side: DataFrame, parts: int, mine: str, other: str, copies: int) -> DataFrame:
        # By content, so that a task that runs again deals the same.
        place = F.pmod(F.xxhash64(*side.columns), F.lit(parts)).cast("int")
        return side.withColumns({mine: place, other: F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))})

    lefts_dealt = dealt(left.where(F.col(key).isNull()), rows, "_row", "_column", columns)
    rights_dealt = dealt(right.where("_right_key is null").drop("_right_key"), columns, "_column", "_row", rows)
    pairs = lefts_dealt.join(rights_dealt, ["_row", "_column"]).drop("_row", "_column")
    return found.unionByName(pairs.select(*found.columns))


def _grid(lefts: int, rights: int, max_pairs: int) -> tuple[int, int]:
    """Parts of the left and of the right rows for blocks of ``max_pairs`` pairs, as square as the sides allow."""
    side = max(1, math.isqrt(max_pairs))
    left_side = min(lefts, max(side, max_pairs // max(1, rights)))
    right_side = max(1, min(rights, max_pairs // left_side))
    return -(-lefts // left_side), -(-rights // right_side)


def lookup_code(df: DataFrame, name: str, codes: DataFrame, code_name: str, code: str) -> DataFrame:
    """Code of a name, else the name read as a whole number, else the row is dropped.

    ``codes`` has one row per name.
    """
    table = codes.select(F.col(code_name).alias("_name"), F.col(code).cast("bigint").alias("_code"))
    key = strip(F.lower(F.col(name)))
    return (df.join(table, key == F.col("_name"), "left")
            .withColumn(code, F.coalesce("_code", strip(name).try_cast("bigint")))
            .where(F.col(code).isNotNull())
            .drop("_name", "_code"))


def fallback_sources(sources: Sequence[DataFrame], query: str, position: str) -> DataFrame:
    """Per query the first hit of the first source that has any."""
    return first_wins_union(sources, [query], position)


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int,
                  rank: str = "rank") -> DataFrame:
    """the first ``n`` rows of each group with their 1-based rank.

    For small ``n`` Spark prunes to ``n`` rows per group in every task before
    the shuffle, so the size of a group does not matter. For a larger one rows
    are counted over ranges of the whole order; ``first_per_group`` cuts them first.
    """
    if n > WINDOW_PRUNE_LIMIT:
        return numbered(df, groups, order, rank).where(F.col(rank) <= n)
    window = W.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window).cast("bigint")).where(F.col(rank) <= n)


def _same(groups: Sequence[str], prefix: str) -> Column:
    """Equal groups, where the other side's columns have a ``prefix``; NULL is a group."""
    return reduce(lambda a, b: a & b, (F.col(g).eqNullSafe(F.col(prefix + g)) for g in groups), F.lit(True))


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """``df`` with the 1-based place of each row in its group's ``order``, which must be unique.

    Rows are sorted over all tasks by group and order and counted inside each
    range; what is added up is one row per range and group. So neither a large
    group nor, without ``groups``, the whole table lies in one task.
    """
    order = [*[F.col(g).asc_nulls_first() for g in groups], *order]
    stored = materialise(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
                         "numbered")
    part = F.shiftright("_at", 33)
    runs = (stored.groupBy(part.alias("_part"), *groups).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows")))
    earlier = W.partitionBy(*groups).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select("_part", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
                       *[F.col(g).alias(f"_of_{g}") for g in groups])
    place = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return (stored.join(runs, (part == F.col("_part")) & _same(groups, "_of_"))
            .select(*df.columns, place.alias(rank)))


def near_the_top(df: DataFrame, groups: Sequence[str], value: str, n: int, descending: bool = False) -> DataFrame:
    """The rows of ``df`` that can be among the first ``n`` of their group by the number ``value``: those and not many more.

    Radix selection: a histogram per group finds the bin in which the n-th
    value lies, and that bin is cut into bins again, until it holds few rows or
    one value. A pass moves a row per task, group and bin, whatever a group's
    size. Rows whose value is missing or not finite stay.
    """
    x = F.col(value).cast("double")
    x = -x if descending else x
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    named = [F.col(g).alias(f"_of_{g}") for g in groups]
    values = materialise(df.where(finite).select(*groups, x.alias("_x")), "values")
    state = (values.groupBy(*named).agg(F.count("*").alias("_held"), F.min("_x").alias("_low"), F.max("_x").alias("_high"))
             .where(F.col("_held") > n).withColumn("_need", F.lit(n).cast("bigint")))
    bins = [f"_of_{g}" for g in groups]
    for _ in range(REFINEMENTS):
        state = materialise(state, "cuts")
        if state.where((F.col("_held") > max(n, WINDOW_PRUNE_LIMIT)) & (F.col("_low") < F.col("_high"))).isEmpty():
            break
        width = (F.col("_high") - F.col("_low")) / BINS
        slot = F.least(F.floor(F.try_divide(F.col("_x") - F.col("_low"), width)), F.lit(BINS - 1))
        counts = (values.join(state, _same(groups, "_of_")).where(F.col("_x").between(F.col("_low"), F.col("_high")))
                  .groupBy(*bins, "_need", F.coalesce(slot, F.lit(0)).alias("_slot"))
                  .agg(F.count("*").alias("_held"), F.min("_x").alias("_low"), F.max("_x").alias("_high")))
        earlier = W.partitionBy(*bins).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_held").over(earlier), F.lit(0)))
        state = (counts.where((F.col("_before") < F.col("_need")) & (F.col("_need") <= F.col("_before") + F.col("_held")))
                 .select(*bins, "_held", "_low", "_high", (F.col("_need") - F.col("_before")).alias("_need")))
    cuts = state.select(*bins, F.col("_high").alias("_cut"))
    stays = F.col("_cut").isNull() | ~F.coalesce(finite, F.lit(False)) | (x <= F.col("_cut"))
    return df.join(cuts, _same(groups, "_of_"), "left").where(stays).select(*df.columns)


def first_per_group(df: DataFrame, groups: Sequence[str], value: str, n: int, ties: Sequence[Column], descending: bool = False,
                    rank: str = "rank") -> DataFrame:
    """the first ``n`` rows of each group by a number, then by ``ties`` (together unique), for any ``n`` and group size."""
    order = [F.desc(value) if descending else F.asc(value), *ties]
    if n > WINDOW_PRUNE_LIMIT:
        df = near_the_top(df, groups, value, n, descending)
    return top_per_group(df, groups, order, n, rank)


def picked(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``table`` with only the pages that can hold the keys in ``wanted``, where they are few; all of it otherwise.

    For a stored table that is sorted by ``key``. The join with ``wanted`` is
    still to be done: a page holds other keys too.
    """
    keys = [r[0] for r in wanted.select(key).distinct().limit(PUSHED_KEYS + 1).collect()]
    if len(keys) > PUSHED_KEYS:
        return table
    # One comparison each: of a longer list the scan would use the smallest and the largest value only.
    return table.where(reduce(lambda a, b: a | b, (F.col(key) == k for k in sorted(k for k in keys if k is not None)), F.lit(False)))


def group_quota(target: int, groups: int) -> int:
    """rows each group may give, never below 5."""
    return max(5, target // groups)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """the first ``n`` rows in ``order``."""
    return df.orderBy(*order).limit(n)


def near_top_rows(df: DataFrame, score: str, n: int) -> DataFrame:
    """The rows of ``df`` that can be among the ``n`` with the highest positive ``score``, all equal ones included.

    A histogram of the score in eighths of an octave (a few hundred rows) finds
    the bucket that holds the n-th row; the rows from that bucket up are left.
    """
    bucket = F.floor(F.log2(F.col(score).cast("double")) * 8)
    above = W.orderBy(F.desc("_bucket"))
    cut = (df.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
           .withColumn("_before", F.sum("_rows").over(above) - F.col("_rows"))
           .where(F.col("_before") < n)
           .agg(F.coalesce(F.min("_bucket"), F.lit(0)).alias("_cut")))
    return df.where(bucket >= cut.scalar())


def top_n_pruned(df: DataFrame, score: str, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the highest positive ``score``, ties by ``key``, for large ``n``; only rows near the top are sorted."""
    return near_top_rows(df, score, n).orderBy(F.desc(score), key).limit(n)


def resolve_tags(queries: DataFrame, query: str, candidates: DataFrame, items: DataFrame, tags: str,
                 overrides: DataFrame, candidate_limit: int = 5) -> DataFrame:
    """A10: the tag each query stands for.

    ``candidates`` has (query, tag, position), ``items`` an array column ``tags``
    and ``overrides`` one (query, tag) row per fixed query. A fixed tag wins;
    else, among the first ``candidate_limit`` candidates, the tag that most items
    carry, the earlier candidate on a tie. Queries without any tag are NULL.
    """
    shortlist = top_per_group(candidates, [query], [F.asc("position")], candidate_limit, "_place")
    # Counted before the join, so a tag on very many items is one row per task.
    coverage = (items.select(F.explode(F.array_distinct(tags)).alias("tag"))
                .groupBy("tag").agg(F.count("*").alias("items")))
    best = (shortlist.join(coverage, "tag", "left")
            .groupBy(query)
            .agg(F.max_by(F.struct("tag", F.coalesce("items", F.lit(0)).alias("items")),
                          F.struct(F.coalesce("items", F.lit(0)), -F.col("position"))).alias("_best")))
    # Fixed queries are looked up without their case and outer white space.
    fixed = overrides.select(strip(F.lower(F.col(query))).alias("_plain"), F.col("tag").alias("_fixed"))
    return (queries.select(query).distinct().withColumn("_plain", strip(F.lower(F.col(query))))
            .join(fixed, "_plain", "left").join(best, query, "left")
            .select(query, F.coalesce("_fixed", "_best.tag").alias("tag"),
                    F.when(F.col("_fixed").isNull(), F.col("_best.items")).alias("items")))
