"""Helpers shared by the corpus operators: reading, row numbers, sorted names and connected components."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.session import materialise

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def with_row(docs: DataFrame, name: str) -> DataFrame:
    """Number the rows of a stored table (Parquet files).

    The number is the place of the file among the table's sorted files (from
    bit 40 on) and of the row in the file, so all scans agree on it, however
    Spark cuts the files. It tells repeated rows apart, which ``doc_id``
    cannot.
    """
    place = F.col("_metadata.row_index")
    # An empty authority is written as three slashes or left out.
    files = sorted({re.sub("^([^:/]+):///", r"\1:/", f) for f in docs.inputFiles()})
    if len(files) < 2:
        return docs.withColumn(name, place)
    # The names are URLs, so they hold no line feed.
    numbers = (docs.sparkSession.range(1).select(F.posexplode(F.split(F.lit("\n".join(files)), "\n")))
               .select(F.col("col").alias("_file"), F.shiftleft(F.col("pos").cast("long"), 40).alias("_first")))
    # Every row needs its file: one that is not listed must not fall out of the join unseen.
    first = F.coalesce("_first", F.raise_error(F.concat(F.lit("not a listed file: "), "_file")).cast("long"))
    return (docs.select("*", F.regexp_replace("_metadata.file_path", "^([^:/]+):///", "$1:/").alias("_file"), place.alias(name))
            .join(F.broadcast(numbers), "_file", "left").withColumn(name, F.col(name) + first).drop("_file", "_first"))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound the rows of an Arrow batch, so that a run of very long texts fits a Python worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def extended(docs: DataFrame, added: str, passed: list[str] | None = None) -> tuple[list[int], StructType]:
    """Places of the columns of ``docs`` that a task hands on, and the schema of its result.

    ``added`` declares the new columns; columns of ``docs`` with such a name
    (in any case) are replaced. ``passed`` names the columns to hand on, all
    others if it is not given.
    """
    new = StructType.fromDDL(added).fields
    names = {f.name.lower() for f in new}
    places = [i for i, f in enumerate(docs.schema.fields)
              if f.name.lower() not in names and (passed is None or f.name in passed)]
    return places, StructType([docs.schema.fields[i] for i in places] + new)


def runs_of(texts: list[bytes], size: int = 1 << 20) -> Iterator[list[bytes]]:
    """``texts`` in runs of about ``size`` bytes; a longer one is a run of its own."""
    run, total = [], 0
    for text in texts:
        if run and total + len(text) > size:
            yield run
            run, total = [], 0
        run.append(text)
        total += len(text)
    if run:
        yield run


def sorted_names(keys: DataFrame, columns: list[str], name: str, first: int = 0) -> DataFrame:
    """Give each row of ``keys`` (distinct) its rank in sorted order, dense and counted from ``first``.

    Rows are sorted inside range partitions; only the size of each partition
    is summed up over all of them. The ranks do not depend on where the
    ranges were cut.
    """
    ranged = (keys.select(*columns).repartitionByRange(*[F.col(c) for c in columns])
              .sortWithinPartitions(*columns)
              .withColumn("_at", F.monotonically_increasing_id()))
    stored = materialise(ranged, "names")
    part = F.shiftright("_at", 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # One row per partition of the table above.
    before = sizes.select("_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_before"))
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (stored.withColumn("_part", part).join(F.broadcast(before), "_part")
            .select(*columns, (F.col("_before") + local + F.lit(first)).alias(name)))


def components(edges: DataFrame, purpose: str = "components", rounds: int = 60) -> DataFrame:
    """Smallest reachable node for every node of ``edges`` (a, b): columns (node, component).

    Alternates two steps until nothing changes: every node links its larger
    neighbours, then its smaller ones, to the smallest of its neighbourhood.
    The number of rounds grows with the logarithm of the longest path. A hub
    is no bottleneck: minima are pre-aggregated and hub rows of the join are
    split by adaptive execution, because both sides are shuffled for it.
    """
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = materialise(clean, purpose)
    previous = None
    for _ in range(rounds):
        both = current.union(current.select("b", "a"))
        low = materialise(both.groupBy("a").agg(F.min("b").alias("m")), purpose)
        # Large step: neighbours above a node go to the minimum of it and its neighbours.
        large = (current.select(F.col("b").alias("u"), F.col("a").alias("v"))
                 .join(low.withColumnRenamed("a", "u"), "u")
                 .select(F.col("v").alias("a"), F.least("u", "m").alias("b")).distinct())
        large = materialise(large, purpose)
        # Small step: a node and its neighbours below go to the smallest of them.
        low = materialise(large.groupBy("a").agg(F.min("b").alias("m")), purpose)
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        current = materialise(small, purpose)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == previous:
            break
        previous = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = current.select(F.col("b").alias("a"), "b").distinct()
    return current.union(roots).select(F.col("a").alias("node"), F.col("b").alias("component")).distinct()


#: Row numbers that may be broadcast: 8 bytes each.
BROADCAST_ROWS = 1_000_000


def by_row(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Join ``docs`` with the stored table ``rows`` on ``_row``.

    The rows are counted: up to a bound they are broadcast and the texts stay
    where they are; beyond it both sides are shuffled, the rows being hashed.
    """
    small = rows.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(rows) if small else rows.hint("shuffle_hash"), "_row", how)
