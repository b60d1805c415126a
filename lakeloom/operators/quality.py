"""Table audits, layer manifests and removed-row counts (A1-A4, Q1-Q4)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.score import rounded


def table_profile(df: DataFrame, name: str, layer: str | None = None, stored: bool = False) -> DataFrame:
    """A1+A3: one row with rows, column count, column list and the NULL count of every column.

    ``stored`` adds file_count and size_kb of a table read from files. All of it
    is one pass: counted per file first, then added up.
    """
    names = df.columns
    nulls = [f"_nulls{i}" for i in range(len(names))]
    counts = [F.count("*").alias("_rows"), *[
        F.count_if(F.col(f"`{c}`").isNull()).alias(n) for c, n in zip(names, nulls)]]
    if stored:
        per_file = (df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"))
                    .groupBy("_file").agg(*counts, F.max("_size").alias("_size")))
        counted = per_file.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_rows", *nulls)],
                               F.count("*").alias("file_count"), _kilobytes(F.sum("_size")).alias("size_kb"))
    else:
        counted = df.agg(*counts)
    return counted.select(
        F.lit(name).alias("table_name"), F.lit(layer).alias("layer"),
        F.col("_rows").alias("row_count"), F.lit(len(names)).cast("bigint").alias("col_count"),
        F.array(*[F.lit(c) for c in names]).alias("columns"),
        F.create_map(*[x for c, n in zip(names, nulls) for x in (F.lit(c), F.col(n))]).alias("null_counts"),
        *(["file_count", "size_kb"] if stored else []))


def _kilobytes(size: Column) -> Column:
    return rounded(F.coalesce(size, F.lit(0)) / 1024.0, 2)


def null_rates(profile: DataFrame) -> DataFrame:
    """A3: (table_name, column_name, null_count, null_rate) from profiles."""
    return (profile.select("table_name", "row_count", F.explode("null_counts").alias("column_name", "null_count"))
            .select("table_name", "column_name", "null_count",
                    F.coalesce(F.try_divide("null_count", "row_count"), F.lit(0.0)).alias("null_rate")))


def file_inventory(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """A1: (path, length) of every file of a table, with or without rows.

    Only the listing is read, not the files; names that begin with an
    underscore or a dot are no part of a table.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return listed.select("path", "length").where(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]"))


def inventory_size(files: DataFrame, name: str) -> DataFrame:
    """A1: (table_name, file_count, empty_files, size_kb) of an inventory."""
    return files.agg(F.lit(name).alias("table_name"), F.count("*").alias("file_count"),
                     F.count_if(F.col("length") == 0).alias("empty_files"), _kilobytes(F.sum("length")).alias("size_kb"))


def stored_size(df: DataFrame, name: str) -> DataFrame:
    """A1: (table_name, file_count, size_kb) of the files that the rows of a table come from; ``file_inventory`` has all files."""
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
    return (files.groupBy("f").agg(F.max("s").alias("s"))
            .agg(F.lit(name).alias("table_name"), F.count("*").alias("file_count"),
                 _kilobytes(F.sum("s")).alias("size_kb")))


def compression(text_sizes: DataFrame, stored_sizes: DataFrame) -> DataFrame:
    """Q4: (table_name, text_kb, stored_kb, ratio) of tables kept in both forms."""
    left = text_sizes.select("table_name", F.col("size_kb").alias("text_kb"))
    right = stored_sizes.select("table_name", F.col("size_kb").alias("stored_kb"))
    return left.join(right, "table_name").select(
        "*", rounded(F.try_divide("text_kb", "stored_kb"), 2).alias("ratio"))


def _short(df: DataFrame, key: str) -> Column:
    """A key as it is grouped: a long text by its 256-bit digest, so that texts do not travel."""
    column = F.col(f"`{key}`")
    if dict(df.dtypes).get(key) != "string":
        return column.alias(key)
    return F.when(F.octet_length(column) > 64, F.sha2(column, 256)).otherwise(column).alias(key)


def key_profile(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Q2: one row with rows, distinct keys, rows of repeated keys beyond the first, and NULL keys."""
    per_key = df.select(*[_short(df, k) for k in keys]).groupBy(*keys).agg(F.count("*").alias("_rows"))
    is_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return per_key.agg(
        F.lit(name).alias("table_name"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(is_null, F.col("_rows"))), F.lit(0)).alias("null_keys"))


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)


def layer_totals(profiles: DataFrame, layer: str = "layer") -> DataFrame:
    """A2: per layer the tables, the rows and SUCCESS or EMPTY."""
    return profiles.groupBy(layer).agg(
        F.count("*").alias("total_tables"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.when(F.count("*") > 0, "SUCCESS").otherwise("EMPTY").alias("status"))


def _now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")


PROFILE = ("table_name string, layer string, row_count bigint, col_count bigint, columns array<string>, "
           "null_counts map<string,bigint>, file_count bigint, size_kb double")


def write_audited(df: DataFrame, path: str, name: str, layer: str | None = None, write=None) -> DataFrame:
    """A1+A3+A4 while writing: the profile of a table from the counts that its own write collects.

    ``write`` (df, path) stores the table, as Parquet by default. Rows and
    NULLs are observed by that job, sizes come from the listing of what it
    wrote: the table is not read again. The result is one row, as from
    ``table_profile`` with ``stored``.
    """
    seen = Observation(f"audit {name}")
    observed = audited(df, seen, *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls{i}") for i, c in enumerate(df.columns)])
    if write is None:
        observed.write.mode("overwrite").option("compression", "snappy").parquet(path)
    else:
        write(observed, path)
    counts = seen.get
    nulls = {c: counts[f"nulls{i}"] for i, c in enumerate(df.columns)}
    spark = df.sparkSession
    row = spark.createDataFrame([(name, layer, counts["rows"], len(df.columns), df.columns, nulls)], PROFILE.rsplit(", ", 2)[0])
    sizes = inventory_size(file_inventory(spark, path), name)
    return row.join(sizes.select("table_name", "file_count", "size_kb"), "table_name")


def audit_layer(tables: dict[str, DataFrame | None], layer: str, pipeline: str,
                keys: dict[str, Sequence[str]] | None = None, paths: dict[str, Sequence[str]] | None = None,
                profiles: Sequence[DataFrame] = ()) -> DataFrame:
    """Q1/Q2: the manifest of a layer as one row; absent tables are left out.

    A layer with a table is a SUCCESS, one without any is EMPTY. ``keys`` names
    the key columns to check per table, ``paths`` the files of a table, so that
    files without rows count too. ``profiles`` are rows of ``write_audited``,
    for tables that need no scan any more.
    """
    present = {n: df for n, df in tables.items() if df is not None}
    if not present and not profiles:
        counts = "row_count:bigint,col_count:bigint,columns:array<string>,file_count:bigint,size_kb:double"
        checks = ",distinct_keys:bigint,duplicate_rows:bigint,null_keys:bigint" if keys else ""
        return SparkSession.active().range(1).select(
            F.lit(pipeline).alias("pipeline_name"), F.lit(layer).alias("layer"), _now(),
            F.lit(0).cast("bigint").alias("total_tables"), F.lit(0).cast("bigint").alias("total_rows"),
            F.lit("EMPTY").alias("status"),
            F.array().cast(f"array<struct<table_name:string,layer:string,{counts}{checks},null_counts:string>>").alias("tables"))

    def profile(name: str, df: DataFrame) -> DataFrame:
        if not paths or name not in paths:
            return table_profile(df, name, layer, stored=True)
        sizes = inventory_size(file_inventory(df.sparkSession, list(paths[name])), name)
        return table_profile(df, name, layer).join(sizes.select("table_name", "file_count", "size_kb"), "table_name")

    per_table = union_all([*(p.select(*[c.strip().split(" ")[0] for c in PROFILE.split(", ")]) for p in profiles),
                           *(profile(n, df) for n, df in present.items())])
    checked = [key_profile(df, n, keys[n]) for n, df in present.items() if keys and n in keys]
    if checked:
        per_table = per_table.join(union_all(checked).drop("row_count"), "table_name", "left")
    # One row per table of the layer.
    return per_table.agg(
        F.lit(pipeline).alias("pipeline_name"), F.lit(layer).alias("layer"),
        _now(), F.count("*").alias("total_tables"), F.sum("row_count").alias("total_rows"),
        F.lit("SUCCESS").alias("status"),
        F.array_sort(F.collect_list(F.struct(*per_table.columns[0:1], *[
            c for c in per_table.columns[1:] if c != "null_counts"], F.to_json("null_counts").alias("null_counts")
        ))).alias("tables"))


def gold_profile(gold: DataFrame, soup: str = "metadata_soup") -> DataFrame:
    """Q3: rows, columns, and the missing and the empty texts, which are different things."""
    return gold.agg(
        F.count("*").alias("row_count"), F.lit(len(gold.columns)).cast("bigint").alias("col_count"),
        F.count_if(F.col(soup).isNull()).alias("null_soup"), F.count_if(F.col(soup) == "").alias("empty_soup"))


def audit_gold(gold: DataFrame, recommender=None, classifier=None, metrics: DataFrame | None = None,
               sample_text: str = "Wonderful story, and the cast plays it well.") -> DataFrame:
    """Q3: the Gold manifest as one row, with a smoke test of both models.

    The recommender is asked for three items like the first one, the classifier
    scores one text. The status follows from what was found.
    """
    spark = gold.sparkSession
    profile = gold_profile(gold)
    rec_status = rec_test = sent_status = sent_test = None
    if recommender is not None:
        first = gold.where("id is not null").orderBy("id").limit(1).select(F.lit(0).alias("query_id"), F.col("id").cast("string").alias("query"))
        hits = recommender.scores(recommender.resolve(first), 3).agg(F.count("*").alias("hits"))
        rec_status, rec_test = "READY", F.when(hits.scalar() > 0, "PASSED").otherwise("FAILED")
    if classifier is not None:
        text = spark.createDataFrame([(0, sample_text)], "id int, text string")
        label = classifier.score(text, "id", "text").agg(F.max("label")).scalar()
        sent_status, sent_test = "READY", F.when(label.isNotNull(), "PASSED").otherwise("FAILED")
    report = F.lit(None).cast("string")
    if metrics is not None:
        report = metrics.agg(F.max(F.to_json(F.struct(*metrics.columns)))).scalar()
    rec_test = F.lit("SKIPPED") if rec_test is None else rec_test
    sent_test = F.lit("SKIPPED") if sent_test is None else sent_test
    healthy = (F.col("row_count") > 0) & (rec_test != "FAILED") & (sent_test != "FAILED")
    return profile.select(
        "*", F.when(healthy, "SUCCESS").otherwise("FAILED").alias("status"),
        F.lit(rec_status or "NOT_TRAINED").alias("recommender_status"), rec_test.alias("recommender_test"),
        F.lit(sent_status or "NOT_TRAINED").alias("sentiment_status"), sent_test.alias("sentiment_test"),
        report.alias("sentiment_metrics"))


def removed_rows(before: DataFrame, after: DataFrame, step: str) -> DataFrame:
    """A4: (step, rows_before, rows_after, rows_removed)."""
    kept = after.agg(F.count("*")).scalar()
    return before.agg(F.lit(step).alias("step"), F.count("*").alias("rows_before"), kept.alias("rows_after")).withColumn(
        "rows_removed", F.col("rows_before") - F.col("rows_after"))


def duplicate_rows(df: DataFrame, keys: Sequence[str], step: str) -> DataFrame:
    """A4 for deduplication: the rows D1 removes, without running it."""
    counts = df.select(*[_short(df, k) for k in keys]).groupBy(*keys).agg(F.count("*").alias("_rows"))
    return counts.agg(F.lit(step).alias("step"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_before"),
                      F.count("*").alias("rows_after")).withColumn(
        "rows_removed", F.col("rows_before") - F.col("rows_after"))


def audited(df: DataFrame, seen: Observation, *metrics: Column) -> DataFrame:
    """A4 without a second pass: ``seen`` gets the row count and metrics of ``df`` when it is written."""
    return df.observe(seen, F.count("*").alias("rows"), *metrics)
