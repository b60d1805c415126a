"""Readers (S1-S4, S9, S10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.sources.schemas import CORRUPT, LANDING, text_schema

ORDER = "_order"

# Cell texts that mean "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


class MissingInput(FileNotFoundError):
    """A required input table does not exist."""


def null_tokens(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn the no-value texts of the given (default: all) columns into NULL."""
    return df.withColumns({
        c: F.when(~F.col(c).isin(*NA_TOKENS), F.col(c)) for c in (columns or df.columns)})


def file_order() -> Column:
    """Row order of a file table: batch folder, part number, file, place in the file."""
    path = F.col("_metadata.file_path")
    part = F.lpad(F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1), 10, "0")
    return F.struct(F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("folder"), part.alias("part"),
                    path.alias("file"), F.monotonically_increasing_id().alias("place"))


def read_text_table(spark: SparkSession, path: str | list[str], columns: Sequence[str], na_tokens: bool = True,
                    multi_line: bool = True, keep_order: bool = False) -> DataFrame:
    """Header CSV whose cells are all text.

    Quotes are doubled inside quoted cells, and cells may hold commas and line
    breaks. A multi-line file is read by one task, so large tables should be
    many files, which is what ``append_batch`` writes. ``keep_order`` adds the
    sortable ``_order`` column that first-row deduplication needs.
    """
    df = (spark.read.schema(text_schema(list(columns)))
          .option("header", True).option("enforceSchema", False)
          .option("multiLine", multi_line).option("quote", '"').option("escape", '"')
          .option("recursiveFileLookup", True)
          .csv(path))
    if keep_order:
        df = df.select("*", file_order().alias(ORDER))
    return null_tokens(df, columns) if na_tokens else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S4."""
    return spark.read.parquet(path)


def read_landing(spark: SparkSession, path: str, schema: T.StructType = LANDING) -> DataFrame:
    """Nested detail records as JSON lines, with a fixed schema.

    Objects in lists are kept whole, as JSON text. A line that cannot be read
    is kept too, in a column of its own, and counted by ``landing_rejects``.
    """
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def existing_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """The non-NULL keys of a table, one column wide."""
    return df.select(key).where(F.col(key).isNotNull())


def optional(read, *args, **kwargs) -> DataFrame | None:
    """Run a reader, or return None when its path does not exist."""
    try:
        return read(*args, **kwargs)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def required(read, *args, **kwargs) -> DataFrame:
    """Run a reader, or raise ``MissingInput`` when its path does not exist."""
    df = optional(read, *args, **kwargs)
    if df is None:
        raise MissingInput(f"missing required table: {args[1:] or kwargs}")
    return df
