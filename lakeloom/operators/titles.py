"""Title lookup by a positional gram index (H3).

Every title is filed under its grams of three characters with the places where
they stand, and under its shorter grams for queries of one or two characters.
Grams know how many titles have them. A query is looked up under the rarest of
its grams only; the place of that gram in the title says where the query would
have to stand, and the title is compared there. So the work follows the titles
that share a query's rarest gram, also where all titles begin alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.text import is_id_query, title_key
from lakeloom.operators.relational import picked
from lakeloom.session import materialise, work_path
from lakeloom.sources.readers import optional

GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """(gram, at) of all grams of ``size`` characters, none for a shorter text; places are counted from 0."""
    last = F.length(text) - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(F.substring(text, i + 1, F.lit(size)).alias("gram"), i.alias("at")))


@dataclass
class TitleIndex:
    """Stored: rows by id, titles with their first and last row, postings of grams, and counts of grams; ids alone where there are no titles."""

    ids: DataFrame
    titles: DataFrame | None = None
    grams: DataFrame | None = None
    counts: DataFrame | None = None

    @classmethod
    def build(cls, items: DataFrame, row: str, item: str = "id", title: str | None = "title", path: str | None = None) -> TitleIndex:
        """File ``items`` (row numbers, ids, titles) under ``path``, by default in the shared folder. Rows without an id are no items."""
        spark = items.sparkSession
        path = path or work_path(spark, "titles")
        rows = items.where(F.col(item).isNotNull())
        (rows.select(F.col(item).cast("bigint").alias("id"), F.col(row).alias("row"))
         .groupBy("id").agg(F.max("row").alias("row")).write.parquet(f"{path}/ids"))
        if title is None:
            return cls.load(spark, path)
        # A title stands for its last row and is tried in the order of its first.
        (rows.select(title_key(title).alias("title"), F.col(row).alias("row")).where(F.col("title").isNotNull())
         .groupBy("title").agg(F.min("row").alias("first"), F.max("row").alias("last"))
         .repartitionByRange("first").sortWithinPartitions("first").write.option("parquet.page.size", 1 << 16).parquet(f"{path}/titles"))
        titles = spark.read.parquet(f"{path}/titles")
        listed = F.concat(*[_grams(F.col("title"), n) for n in range(1, GRAM + 1)])
        # Titles are named by their first row. Grams are dealt by ranges once, which is enough for the grouping too.
        (titles.select("first", F.explode_outer(listed).alias("g")).where("g is not null").select("g.gram", "first", "g.at")
         .repartitionByRange("gram", "first").groupBy("gram", "first").agg(F.sort_array(F.collect_list("at")).alias("places"))
         .sortWithinPartitions("gram", "first").write.option("parquet.page.size", 1 << 16).parquet(f"{path}/grams"))
        (spark.read.parquet(f"{path}/grams").groupBy("gram").agg(F.count("*").alias("titles"))
         .write.parquet(f"{path}/counts"))
        return cls.load(spark, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TitleIndex:
        tables = (optional(spark.read.parquet, f"{path}/{name}") for name in ("titles", "grams", "counts"))
        return cls(spark.read.parquet(f"{path}/ids"), *tables)

    def rarest(self, probes: DataFrame) -> DataFrame:
        """(query_id, text, gram, at) of each query's gram that fewest titles have; queries with an unknown gram match nothing."""
        size = F.least(F.length("text"), F.lit(GRAM))
        listed = F.when(size == 1, _grams(F.col("text"), 1)).when(size == 2, _grams(F.col("text"), 2)).otherwise(_grams(F.col("text"), GRAM))
        asked = probes.select("query_id", "text", F.explode(listed).alias("g")).select("query_id", "text", "g.gram", "g.at")
        known = asked.join(self.counts, "gram", "left")
        best = known.groupBy("query_id", "text").agg(
            F.min_by(F.struct("gram", "at"), F.struct("titles", "at")).alias("g"), F.count_if(F.col("titles").isNull()).alias("unknown"))
        return best.where("unknown = 0").select("query_id", "text", "g.gram", "g.at")

    def containing(self, probes: DataFrame) -> DataFrame:
        """(query_id, title, first, last): titles that contain the (non-empty) text of each probe (query_id, text)."""
        rarest = materialise(self.rarest(probes), "rarest")
        met = materialise(picked(self.grams, "gram", rarest).join(rarest, "gram").select("query_id", "text", "at", "first", "places"), "met")
        titles = picked(self.titles, "first", met)
        there = F.exists("places", lambda p: (p >= F.col("at")) & (F.substring("title", p - F.col("at") + 1, F.length("text")) == F.col("text")))
        return met.join(titles, "first").where(there).select("query_id", "title", "first", "last")

    def find(self, queries: DataFrame) -> DataFrame:
        """(query_id, row) of the item each query (query_id, query) means; unknown queries are left out."""
        asked = queries.select("query_id", "query", title_key("query").alias("text"), is_id_query("query").alias("by_id"))
        by_id = (asked.where("by_id").select("query_id", F.col("query").try_cast("bigint").alias("id"))
                 .join(self.ids, "id").groupBy("query_id").agg(F.max("row").alias("row")))
        if self.titles is None:
            return by_id
        named = asked.where("not by_id").select("query_id", "text")
        exact = (named.join(self.titles.withColumnRenamed("title", "text"), "text")
                 .groupBy("query_id").agg(F.max("last").alias("row")))
        still = named.join(exact.select("query_id"), "query_id", "left_anti")
        blank = still.where("text = ''").select("query_id", self.titles.agg(F.min_by("last", "first")).scalar().alias("row"))
        inside = (self.containing(still.where("text <> ''")).groupBy("query_id").agg(F.min_by("last", "first").alias("row")))
        return by_id.unionByName(exact).unionByName(blank.where(F.col("row").isNotNull())).unionByName(inside)
