"""Stored tables in versions: a folder per version, complete once it is marked so.

A new version is written beside the old ones and counts from the moment its ``_SUCCESS`` mark appears, which the writing job
sets as its last step. So a failed write changes nothing, a reader finishes on the version it began with, and no
data are renamed. Versions are released later.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from medalstar.session import remove_folder

_VERSION = re.compile(r"version-(\d{9})-[0-9a-f]{32}")
_DONE = "_SUCCESS"


def write_files(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def _listing(spark: SparkSession, folder: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def _all_versions(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """(path, complete), oldest first."""
    names = sorted(n for n in _listing(spark, folder) if _VERSION.fullmatch(n))
    return [(f"{folder}/{n}", _DONE in _listing(spark, f"{folder}/{n}")) for n in names]


def versions(spark: SparkSession, folder: str) -> list[str]:
    """The complete versions, oldest first."""
    return [path for path, complete in _all_versions(spark, folder) if complete]


def has_version(spark: SparkSession, folder: str) -> bool:
    return bool(versions(spark, folder))


def current_version(spark: SparkSession, folder: str) -> str:
    """Path of the newest complete version."""
    found = versions(spark, folder)
    if not found:
        raise FileNotFoundError(f"no complete version in {folder}")
    return found[-1]


def read_current(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(current_version(spark, folder))


def new_version(spark: SparkSession, folder: str) -> str:
    """Path of a version to write, behind all that were begun."""
    begun = _all_versions(spark, folder)
    last = int(_VERSION.fullmatch(begun[-1][0].rsplit("/", 1)[-1])[1]) if begun else 0
    return f"{folder}/version-{last + 1:09d}-{uuid.uuid4().hex}"


def write_version(df: DataFrame, folder: str, write: Callable[[DataFrame, str], None] = write_files) -> str:
    """Write ``df`` as the new current version. ``df`` may read the version it replaces."""
    path = new_version(df.sparkSession, folder)
    try:
        write(df, path)
    except Exception:
        remove_folder(df.sparkSession, path)
        raise
    return path


def release_versions(spark: SparkSession, folder: str, keep: int = 1) -> list[str]:
    """Delete all but the newest ``keep`` complete versions, and what older failed writes left. Returns the deleted paths.

    Incomplete versions behind the current one may still be under way and stay.
    """
    if keep < 1:
        raise ValueError("the current version cannot be released")
    kept = versions(spark, folder)[-keep:]
    dropped = [path for path, _ in _all_versions(spark, folder) if kept and path < kept[-1] and path not in kept]
    for path in dropped:
        remove_folder(spark, path)
    return dropped
