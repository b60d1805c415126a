"""Immutable versions of a stored result, and a pointer that one rename moves on.

A version is a folder that is written whole and never changed. Publishing it
takes a number that no other writer has (an exclusive file creation), writes a
small file with the folder's name and renames it to that number; the highest
number is the current version. So a crash at any point leaves the old version
current, readers that are open keep their folder, and of two writers the later
one wins without harming the other.
"""

from __future__ import annotations

import json
import threading
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from lakeloom.session import delete_path
from lakeloom.sources.readers import MissingInput

#: Versions that stay for readers that are still open, the current one included.
KEEP = 3
# A local file system looks for a file before it creates it, so the writers of one process take turns.
_CLAIMING = threading.Lock()


@dataclass(frozen=True)
class Version:
    """A published version: its number, its folder and what its writer noted."""

    number: int
    folder: str
    note: dict


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    files, folder = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in _names(spark, path) if n.isdigit()]


def _read(spark: SparkSession, path: str, number: int) -> Version | None:
    """The version with this number; None if its pointer has been deleted since it was listed."""
    files, file = _files(spark, f"{path}/pointers/{number:012d}")
    if not files.exists(file):
        return None
    stream = files.open(file)
    try:
        said = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Version(number, f"{path}/{said['folder']}", said["note"])


def versions(spark: SparkSession, path: str) -> list[Version]:
    """Published versions that are still there, oldest first."""
    found = (_read(spark, path, n) for n in _numbers(spark, f"{path}/pointers"))
    return [v for v in found if v]


def current(spark: SparkSession, path: str) -> Version | None:
    """The version that was published last, None if there is none."""
    for number in reversed(_numbers(spark, f"{path}/pointers")):
        if version := _read(spark, path, number):
            return version
    return None


def new_folder(path: str) -> str:
    """Folder for one more version; nobody sees it before it is published."""
    return f"{path}/version-{uuid.uuid4().hex}"


def _claim(spark: SparkSession, path: str) -> int:
    """A number above all others that this writer alone has."""
    while True:
        with _CLAIMING:
            taken = _numbers(spark, f"{path}/claims") + _numbers(spark, f"{path}/pointers")
            number = max(taken, default=0) + 1
            files, file = _files(spark, f"{path}/claims/{number:012d}")
            try:
                if files.createNewFile(file):
                    return number
            except Py4JJavaError as error:
                # Another process made the file between the look and the creation.
                if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                    raise


def publish(spark: SparkSession, path: str, folder: str, note: dict | None = None, keep: int = KEEP) -> Version:
    """Make a finished ``folder`` the current version; versions before the last ``keep`` are deleted."""
    files, finished = _files(spark, folder)
    if not files.exists(finished):
        raise MissingInput(f"nothing was written to {folder}")
    number = _claim(spark, path)
    name = folder[len(path) + 1:]
    draft = f"{path}/drafts/{uuid.uuid4().hex}"
    files, file = _files(spark, draft)
    stream = files.create(file, False)
    stream.write(json.dumps({"folder": name, "note": note or {}}).encode())
    stream.close()
    _, target = _files(spark, f"{path}/pointers/{number:012d}")
    files.mkdirs(target.getParent())
    if not files.rename(file, target):
        raise OSError(f"could not publish {folder} as number {number}")
    retire(spark, path, keep)
    return Version(number, folder, note or {})


def publish_note(spark: SparkSession, path: str, note: dict, keep: int = KEEP) -> Version:
    """Publish a version that is nothing but its note."""
    folder = new_folder(path)
    files, empty = _files(spark, folder)
    files.mkdirs(empty)
    return publish(spark, path, folder, note, keep)


def retire(spark: SparkSession, path: str, keep: int = KEEP) -> list[Version]:
    """Delete all but the last ``keep`` versions: first the pointer, so that no reader starts on half a folder."""
    if keep < 1:
        raise ValueError("the current version must stay")
    old = versions(spark, path)[:-keep]
    for version in old:
        delete_path(spark, f"{path}/pointers/{version.number:012d}")
        delete_path(spark, version.folder)
    last = max(_numbers(spark, f"{path}/pointers"), default=0)
    for number in _numbers(spark, f"{path}/claims"):
        if number < last:
            delete_path(spark, f"{path}/claims/{number:012d}")
    return old


def orphans(spark: SparkSession, path: str) -> list[str]:
    """Version folders that nothing points to: left by crashes, or being written now."""
    known = {v.folder for v in versions(spark, path)}
    return [f for n in _names(spark, path) if n.startswith("version-") and (f := f"{path}/{n}") not in known]


def write_version(df: DataFrame, path: str, note: dict | None = None, keep: int = KEEP) -> Version:
    """S5 without a moment in which the table is missing: one more version of a Parquet table."""
    folder = new_folder(path)
    df.write.option("compression", "snappy").parquet(folder)
    return publish(df.sparkSession, path, folder, note, keep)


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that ``write_version`` writes; the reader keeps it while others are published."""
    version = current(spark, path)
    if version is None:
        raise MissingInput(f"no version of {path}")
    return spark.read.parquet(version.folder)
