"""Content-based top-k recommendation.

The index holds one row per item with its weighted terms, bucketed by item, and
the same weights turned over: postings, sorted by term. A table of queries is
resolved to items. For few queries only the postings of their terms are read.
For many, all items are: a bucket holds all of an item's weights, so products
are summed per (query, item) without a shuffle, and each task passes on its
best k+1 items per query. Items that share no term can still win on quality, so
the best k+1 items by quality join every query's candidates; no other item
without a shared term can reach the top k.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.score import (POPULARITY_SCALE, POPULARITY_WEIGHT, RATING_SCALE, RATING_WEIGHT,
                                      SIMILARITY_WEIGHT, rounded, unit_clip)
from lakeloom.operators.relational import PUSHED_KEYS, picked, top_per_group
from lakeloom.operators.tfidf import document_count, vectors, vocabulary
from lakeloom.operators.titles import TitleIndex
from lakeloom.session import materialise, work_path
from lakeloom.sources import versions
from lakeloom.sources.readers import MissingInput

BROADCAST_ROWS = 2_000_000
HOT_TERM_ROWS = 1_000_000
RANK_PLACES = 9
#: Items by quality that the index keeps; for larger k they are looked up in the items.
LEADERS = 1000
#: Rows of a page of postings: a page is read whole for one term, and by bytes alone it would hold 20,000.
POSTINGS_PAGE = 500
#: Terms of all queries together up to which postings are looked up instead of scanned.
FEW_TERMS = 1200
# Columns of the slim index, and their names in the answer.
INDEX_COLUMNS = ("id", "title", "release_year", "genres_clean", "director_clean", "top_cast_clean",
                 "original_language", "vote_average", "vote_count", "popularity", "poster_path")
ANSWER_COLUMNS = {
    "movieId": "id", "title": "title", "release_year": "release_year", "genres": "genres_clean",
    "director": "director_clean", "language": "original_language", "vote_average": "vote_average",
}


def slim_index(items: DataFrame, columns: Sequence[str] = INDEX_COLUMNS) -> DataFrame:
    """H6: only the columns that answers need."""
    return items.select(*columns)


def quality(rating: Column | str, popularity: Column | str) -> Column:
    """The part of the blended score that does not depend on the query."""
    return (unit_clip(rating, RATING_SCALE) * RATING_WEIGHT
            + unit_clip(popularity, POPULARITY_SCALE) * POPULARITY_WEIGHT)


def _table_name(folder: str) -> str:
    """Catalogue name of the bucketed vectors of one version."""
    return f"lakeloom_vectors_{folder.rsplit('-', 1)[-1]}"


def _size_checked(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def resolve_items(queries: DataFrame, items: DataFrame, row: str, item: str = "id",
                  title: str = "title") -> DataFrame:
    """H3: (query_id, row) of the item each query means; unknown queries are left out.

    ``queries`` has (query_id, query). Digits mean an id and nothing else. Other
    text means the title it equals, else the first title that contains it.
    Titles are tried in the order of their first row, and a title stands for
    its last row. ``TitleIndex`` says how; an index of items stores one.
    """
    return TitleIndex.build(items, row, item, title).find(queries)


@dataclass
class ItemIndex:
    """The stored index: vocabulary, item vectors, postings, the slim catalogue, titles and the items of highest quality.

    ``row`` numbers the items, ``item`` is their id, which may repeat.
    """

    vocabulary: DataFrame
    vectors: DataFrame
    postings: DataFrame
    items: DataFrame
    leaders: DataFrame
    titles: TitleIndex

    @classmethod
    def build(cls, items: DataFrame, *, text: str = "metadata_soup", item: str = "id",
              title: str | None = "title", row: str | None = None, order: str | None = None,
              rating: str | Column = "vote_average", popularity: str | Column = "popularity",
              columns: Sequence[str] = INDEX_COLUMNS, stop_words: Sequence[str] = (),
              min_df: int = 2, max_terms: int = 20_000, path: str | None = None,
              buckets: int | None = None, keep: int = versions.KEEP) -> ItemIndex:
        """Fit the vocabulary, weigh every item and publish the tables as one more version of the index.

        ``row`` names a column that numbers the item rows; without it they are
        numbered by the column ``order``, or else in reading order. ``path`` defaults to the shared folder, and
        ``buckets``, the number of files of vectors and postings, to the shuffle partitions.
        The last ``keep`` versions stay for readers that have them open.
        """
        spark = items.sparkSession
        path = path or work_path(spark, "index")
        folder = versions.new_folder(path)
        wanted = dict.fromkeys([item, *([title] if title else []), *columns])
        rows = items.where(F.col(item).isNotNull())
        base = (rows.orderBy(order, item) if order else rows).select(
            (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
            F.col(item).alias("item"), quality(rating, popularity).alias("quality"), *wanted,
            F.col(text).alias("_text"))
        # Row numbers made here hold only for what is written, so the text is written with them.
        stored = base.drop("_text") if row else base
        stored.write.parquet(f"{folder}/items")
        stored = spark.read.schema(stored.schema).parquet(f"{folder}/items")
        rows = base if row else stored
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        vocab = vocabulary(rows, "_text", stop_words, min_df, max_terms, document_count(stored))
        vocab.write.parquet(f"{folder}/vocabulary")
        vocab = spark.read.schema(vocab.schema).parquet(f"{folder}/vocabulary")
        # One task per bucket already, so this is one file per bucket.
        (vectors(rows, "row", "_text", vocab, max_terms, stop_words, ["item", "quality"], buckets)
         .write.format("parquet").bucketBy(buckets, "row").sortBy("row").option("parquet.page.size", 1 << 16)
         .option("path", f"{folder}/vectors").saveAsTable(_table_name(folder)))
        (spark.table(_table_name(folder)).select("row", "item", "quality", F.explode("entries").alias("e"))
         .select("e.index", "row", "item", "quality", "e.weight")
         .repartitionByRange(buckets, "index", "row").sortWithinPartitions("index", "row")
         .write.option("parquet.page.size", 1 << 16).option("parquet.page.row.count.limit", POSTINGS_PAGE).parquet(f"{folder}/postings"))
        candidate = stored.select("row", "item", "quality")
        best = [candidate.orderBy(*cls._leading(boost)).limit(LEADERS).withColumn("boost", F.lit(boost)) for boost in (True, False)]
        best[0].unionByName(best[1]).write.parquet(f"{folder}/leaders")
        named = stored.select("row", "item", *([F.col(title).alias("title")] if title else []))
        TitleIndex.build(named, "row", "item", "title" if title else None, f"{folder}/titles")
        older = versions.versions(spark, path)
        version = versions.publish(spark, path, folder, {"buckets": buckets}, keep)
        left = {v.folder for v in versions.versions(spark, path)}
        for gone in (v for v in older if v.folder not in left):
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(gone.folder)}")
        return cls.open(spark, version)

    @staticmethod
    def _leading(quality_boost: bool) -> list[Column | str]:
        """Order of the items that share no term with a query."""
        return [F.desc(F.round("quality", RANK_PLACES)), "item", "row"] if quality_boost else ["item", "row"]

    @classmethod
    def open(cls, spark: SparkSession, version: versions.Version) -> ItemIndex:
        """The tables of one version; the bucketed one is declared in the session catalogue if it is new there."""
        folder, name = version.folder, _table_name(version.folder)
        read = lambda part: spark.read.parquet(f"{folder}/{part}")
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read("vectors").schema)
            place = f"{folder}/vectors".replace("'", chr(92) + "'")
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (row) SORTED BY (row) "
                      f"INTO {version.note['buckets']} BUCKETS LOCATION '{place}'")
        return cls(read("vocabulary"), spark.table(name), read("postings"), read("items"), read("leaders"),
                   TitleIndex.load(spark, f"{folder}/titles"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ItemIndex:
        """Open the current version of a stored index."""
        version = versions.current(spark, path)
        if version is None:
            raise MissingInput(f"no item index at {path}")
        return cls.open(spark, version)

    def resolve(self, queries: DataFrame) -> DataFrame:
        """H3 over the catalogue of this index."""
        return self.titles.find(queries)

    def _sums(self, terms: DataFrame, count: int) -> DataFrame:
        """(query_id, row, item, quality, similarity) of all pairs that share a term.

        Few terms are looked up in the postings, by pages; for many, the items' own rows are read.
        """
        if count <= FEW_TERMS:
            entries = picked(self.postings, "index", terms)
        else:
            entries = (self.vectors.select("row", "item", "quality", F.explode("entries").alias("e"))
                       .select("row", "item", "quality", "e.index", "e.weight"))
        on = ["index"]
        if count <= BROADCAST_ROWS:
            terms = F.broadcast(terms)
        else:
            # Split the terms that many items share over several tasks. The list
            # of hot terms is part of the vocabulary, whose size is an argument.
            hot = F.broadcast(self.vocabulary.where(F.col("df") > HOT_TERM_ROWS).select(
                "index", F.ceil(F.col("df") / HOT_TERM_ROWS).cast("int").alias("parts")))
            parts = F.coalesce("parts", F.lit(1))
            entries = (entries.join(hot, "index", "left")
                       .withColumn("part", F.pmod(F.xxhash64("row"), parts).cast("int")).drop("parts"))
            terms = (terms.join(hot, "index", "left")
                     .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts"))
            on = ["index", "part"]
        products = entries.join(terms, on).select(
            "query_id", "row", "item", "quality", (F.col("weight") * F.col("query_weight")).alias("product"))
        return products.groupBy("query_id", "row").agg(
            F.max("item").alias("item"), F.max("quality").alias("quality"), F.sum("product").alias("similarity"))

    def scores(self, resolved: DataFrame, k: int, quality_boost: bool = True) -> DataFrame:
        """H4: (query_id, row, item, rank, similarity, final) of the best ``k`` items per query.

        ``resolved`` has (query_id, row). Exact for any number of queries. Scores
        are ranked at nine decimals, ties by id, so that the order of summation
        cannot matter.
        """
        resolved = materialise(resolved.select("query_id", F.col("row").alias("own")), "queries")
        return self._scores(resolved, resolved.count(), k, quality_boost)

    def query_terms(self, resolved: DataFrame, queries: int) -> DataFrame:
        """(query_id, index, query_weight) of the queries' terms; stored."""
        mine = picked(self.vectors, "row", resolved.select(F.col("own").alias("row"))) if queries <= PUSHED_KEYS else self.vectors
        own = _size_checked(resolved, queries)
        return materialise(mine.join(own, F.col("row") == F.col("own")).select("query_id", F.explode("entries").alias("e"))
                           .select("query_id", "e.index", F.col("e.weight").alias("query_weight")), "query-terms")

    def _scores(self, resolved: DataFrame, queries: int, k: int, quality_boost: bool) -> DataFrame:
        base = F.col("quality") if quality_boost else F.lit(0.0)
        own = _size_checked(resolved, queries)
        candidate = ["row", "item", "quality"]
        terms = self.query_terms(resolved, queries)

        def final(similarity: str) -> Column:
            return F.col(similarity) * SIMILARITY_WEIGHT + base if quality_boost else F.col(similarity)

        def best_of(scored: DataFrame, n: int) -> DataFrame:
            order = [F.desc(F.round("final", RANK_PLACES)), F.asc("item"), F.asc("row")]
            return top_per_group(scored.withColumn("final", final("similarity")), ["query_id"], order, n)

        listed = self.leaders.where(F.col("boost") == quality_boost) if k + 1 <= LEADERS else self.items
        best = (listed.select(*candidate).orderBy(*self._leading(quality_boost)).limit(k + 1)
                .agg(F.collect_list(F.struct(*candidate))).scalar())
        unseen = (resolved.select("query_id", F.explode(best).alias("b"))
                  .select("query_id", "b.*", F.lit(0.0).alias("similarity")))
        # The query's own item ranks behind all others, for catalogues of up to k items.
        itself = (self.items.select(*candidate).join(own, F.col("row") == F.col("own"))
                  .select("query_id", *candidate, F.lit(0.0).alias("similarity")))
        # The query's own item may take one place here, hence k+1.
        similar = best_of(self._sums(terms, terms.count()), k + 1).select("query_id", *candidate, "similarity")
        # At most 2k+3 candidates per query from here on; similarity is never negative.
        shortlist = (similar.unionByName(unseen).unionByName(itself)
                     .groupBy("query_id", *candidate).agg(F.max("similarity").alias("similarity"))
                     .join(own, "query_id")
                     .withColumn("similarity", F.when(F.col("row") == F.col("own"), -1.0).otherwise(F.col("similarity"))))
        return best_of(shortlist, k).select("query_id", "row", "item", "rank", "similarity", "final")

    def recommend(self, queries: DataFrame, k: int = 10, quality_boost: bool = True,
                  answer: dict[str, str] | None = None) -> DataFrame:
        """H4+H5: the answer rows for a (query_id, query) table, without unknown queries."""
        answer = ANSWER_COLUMNS if answer is None else answer
        resolved = materialise(self.resolve(queries).select("query_id", F.col("row").alias("own")), "queries")
        count = resolved.count()
        best = self._scores(resolved, count, k, quality_boost).drop("item")
        return (self.items.join(_size_checked(best, count * k), "row")
                .select("query_id", "rank", *[F.col(c).alias(a) for a, c in answer.items()],
                        rounded("similarity").alias("similarity_score"), rounded("final").alias("final_score")))
