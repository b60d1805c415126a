"""Labels, clipping, blending and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.common import as_column

# Fixed values of the ranking formula and the label rule.
SIMILARITY_WEIGHT = 0.80
RATING_WEIGHT = 0.15
POPULARITY_WEIGHT = 0.05
RATING_SCALE = 10.0
POPULARITY_SCALE = 100.0
POSITIVE_FROM = 6.0
DEFAULT_RATING = 7.0


def sentiment_label(rating: Column | str, threshold: float = POSITIVE_FROM) -> Column:
    """X14: 'positive' from ``threshold`` up."""
    return F.when(as_column(rating) >= threshold, "positive").otherwise("negative")


def label_value(label: Column | str) -> Column:
    """1 for 'positive', 0 for anything else."""
    return F.when(as_column(label) == "positive", 1).otherwise(0)


def unit_clip(c: Column | str, scale: float) -> Column:
    """Divide by ``scale`` and keep within [0, 1]; NULL counts 0."""
    share = F.coalesce(as_column(c).cast("double"), F.lit(0.0)) / F.lit(scale)
    return F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0))


def blend(similarity: Column | str, rating: Column | str, popularity: Column | str) -> Column:
    """Similarity, rating and popularity in fixed shares."""
    return (as_column(similarity) * SIMILARITY_WEIGHT
            + unit_clip(rating, RATING_SCALE) * RATING_WEIGHT
            + unit_clip(popularity, POPULARITY_SCALE) * POPULARITY_WEIGHT)


def rounded(c: Column | str, places: int = 4) -> Column:
    """Round half to even."""
    return F.bround(as_column(c), places)
