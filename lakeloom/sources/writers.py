"""Writers (S5-S8, S12)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lakeloom.sources.ledger import KeyLedger
from lakeloom.sources.readers import read_text_table

LEDGER = "_keys"

# A file with line breaks inside cells is read by one task.
ROWS_PER_TEXT_FILE = 50_000


class SchemaMismatch(ValueError):
    """The rows to append do not have the columns of the table."""


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Snappy Parquet."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_text_copy(df: DataFrame, path: str) -> None:
    """CSV copy with a header; nested columns must be text already."""
    _text_writer(df, "overwrite").csv(path)


def _text_writer(df: DataFrame, mode: str):
    return (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
            .option("maxRecordsPerFile", ROWS_PER_TEXT_FILE)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("emptyValue", ""))


def _folder(spark: SparkSession, path: str):
    """(file system, path) pair of a Hadoop path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def text_table_paths(spark: SparkSession, path: str) -> list[str]:
    """What a text table consists of: a plain ``path.csv`` first, then the batches under ``path``."""
    found = []
    for candidate in (f"{path}.csv", path):
        files, folder = _folder(spark, candidate)
        if files.exists(folder):
            found.append(candidate)
    return found


def _batches(spark: SparkSession, path: str) -> list[str]:
    """Names of the batch folders of a text table, in order (folder metadata only)."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    return sorted(n for n in names if n.startswith("batch-"))


def header_of(spark: SparkSession, path: str) -> list[str] | None:
    """Column names in the header of an existing text table, None when there is none."""
    files = [p for p in text_table_paths(spark, path) if p != path] + [f"{path}/{b}" for b in _batches(spark, path)]
    if not files:
        return None
    first = spark.read.option("header", True).option("recursiveFileLookup", True).csv(files[0])
    return first.columns or None


def _number(batch: str) -> int:
    return int(batch.split("-")[1])


def _suffix(batch: str) -> str:
    """Token of a batch, or the unique name it got instead."""
    return batch.split("-", 2)[2]


def append_batch(df: DataFrame, path: str, token: str | None = None, key: str | None = None,
                 extra: list[str] | None = None, numbers: bool = False) -> str:
    """Append rows to a text table as one more batch folder.

    The header of the table must equal the columns of ``df`` in order. Batch
    folders are numbered, so folder order is append order. A ``token`` names
    the batch: writing the same token again replaces that batch, which makes a
    replayed streaming batch harmless. ``key`` also notes the keys of the batch
    in the ledger beside the table, with the columns ``extra``; ``numbers``
    says that keys are whole numbers.
    """
    spark = df.sparkSession
    known = header_of(spark, path)
    if known is not None and known != df.columns:
        raise SchemaMismatch(f"{path}: table has {known}, rows have {df.columns}")
    batches = _batches(spark, path)
    # Without a token the name is unique, so that two writers at once cannot take one folder.
    suffix = f"-{token}" if token else f"-u{uuid.uuid4().hex}"
    again = [b for b in batches if token and _suffix(b) == token]
    if again:
        name = again[0]
    else:
        last = _number(batches[-1]) if batches else 0
        name = f"batch-{last + 1:010d}{suffix}"
    mode = "overwrite" if token else "errorifexists"
    _text_writer(df, mode).csv(f"{path}/{name}")
    if key:
        # After the rows: a crash in between leaves rows to deduplicate, not keys without rows.
        batch = read_text_table(spark, f"{path}/{name}", df.columns, na_tokens=False)
        KeyLedger(spark, path + LEDGER, [key], extra, numbers).append(batch, _suffix(name), _number(name))
    return name


def key_ledger(spark: SparkSession, path: str, columns: list[str], key: str, extra: list[str] | None = None,
               numbers: bool = False, without: str | None = None) -> KeyLedger:
    """The ledger of a text table's keys, brought up to date.

    The text of batches that were written without a key is read once and noted;
    the batch with token ``without``, which is about to be written again, is left out.
    """
    ledger = KeyLedger(spark, path + LEDGER, [key], extra, numbers)
    state = ledger.state()
    missing = [b for b in _batches(spark, path) if not state.covers(_number(b)) and _suffix(b) != without]
    plain = [p for p in text_table_paths(spark, path) if p != path and not state.covers(0)]
    read = lambda paths: read_text_table(spark, paths, columns, na_tokens=False)
    older = plain + [f"{path}/{b}" for b in missing[:-1]]
    if older:
        ledger.append(read(older), None, [0] * bool(plain) + [_number(b) for b in missing[:-1]])
    if missing:
        # The newest batch is a run of its own, as it may be written again.
        ledger.append(read(f"{path}/{missing[-1]}"), _suffix(missing[-1]), _number(missing[-1]))
    return ledger


def known_keys(spark: SparkSession, path: str, columns: list[str], key: str,
               without: str | None = None) -> DataFrame | None:
    """All keys a text table holds, apart from the batch with token ``without``; None for an empty table.

    To compare a batch with them, ``KeyLedger.exclude`` reads only what it needs.
    """
    return key_ledger(spark, path, columns, key, without=without).all(without)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """A bounded audit table as one JSON file."""
    manifest.coalesce(1).write.mode("overwrite").json(path)


def publish(df: DataFrame, name: str, permanent: bool = False) -> None:
    """Make a table visible to SQL, for the session or in the catalogue."""
    if permanent:
        df.write.mode("overwrite").format("parquet").saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)

