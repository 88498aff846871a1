"""Row selection per key and dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalstar.session import new_shared_folder, remove_folder

_FILE_NUMBER = r"^part-(\d+)"  # how Spark names the file of a partition


def top_n_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key.

    Spark turns the rank filter into a group limit that runs before the shuffle as well, so a
    hot key sends at most ``n`` rows per input task across the network.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def ascending(columns: Sequence[str]) -> list[Column]:
    """Total order over the columns with NULLs last."""
    return [F.col(c).asc_nulls_last() for c in columns]


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str]) -> DataFrame:
    """Newest row per key; ``ties`` decides between rows of equal time."""
    return top_n_per_key(df, keys, [F.col(ts).desc_nulls_last(), *ascending(ties)])


def latest_as_of(df: DataFrame, keys: Sequence[str], ts: str, moment: Column, ties: Sequence[str]) -> DataFrame:
    """Newest row per key among those not later than ``moment``."""
    return latest_per_key(df.filter(F.col(ts) <= moment), keys, ts, ties)


def preferred_latest(
    df: DataFrame, keys: Sequence[str], preferred: Column, ts: str, ties: Sequence[str]
) -> DataFrame:
    """Rows that satisfy ``preferred`` win over the rest, then the newest wins."""
    order = [F.when(preferred, 0).otherwise(1), F.col(ts).desc_nulls_last(), *ascending(ties)]
    return top_n_per_key(df, keys, order)


def dedupe_first(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """First row per key in arrival order. ``arrival`` has to order rows totally."""
    return top_n_per_key(df, keys, ascending(arrival))


def dense_key(df: DataFrame, name: str, order_by: Sequence[str]) -> DataFrame:
    """Add a bigint ``name`` numbering the rows 1..N in the order of ``order_by`` (NULLs last).

    ``order_by`` has to identify a row, as the grain of a dimension does. The rows are stored once,
    so that the range shuffle samples a stored table and ``df`` is computed once; the sorted
    partitions are stored in turn, which fixes them against recomputation after a lost executor. A key
    is then the row's position in its file plus the rows of the files before it. Nothing reaches the
    driver. The first folder is removed here, the second by ``session.scratch`` around the final write.
    """
    spark, order = df.sparkSession, ascending(order_by)
    stored, ranged = new_shared_folder(spark, "unsorted"), new_shared_folder(spark, "sorted")
    df.write.parquet(stored)
    rows = spark.read.schema(df.schema).parquet(stored)
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(ranged)
    remove_folder(spark, stored)
    placed = spark.read.schema(df.schema).parquet(ranged).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_position")
    )
    # One row per file, so never more than there are shuffle partitions. Files are numbered in range order.
    number = F.regexp_extract("_file", _FILE_NUMBER, 1).cast("bigint")
    earlier = Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("_file").agg(F.count("*").alias("_rows")).select(
        "_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    key = (F.col("_before") + F.col("_position") + 1).alias(name)
    return placed.join(F.broadcast(before), "_file").select(key, *df.columns)


def _known(members: DataFrame, registry: DataFrame, name: str, order_by: Sequence[str], how: str) -> DataFrame:
    """``members`` joined to their entries, NULL parts of a key equal to each other."""
    entries = registry.select(F.col(name).alias("_key"), *[F.col(c).alias(f"_known{i}") for i, c in enumerate(order_by)])
    match = (members[c].eqNullSafe(entries[f"_known{i}"]) for i, c in enumerate(order_by))
    return members.join(entries, reduce(Column.__and__, match), how)


def grow_registry(registry: DataFrame, members: DataFrame, name: str, order_by: Sequence[str]) -> DataFrame:
    """The key registry (``name``, ``order_by``) with entries for members it lacks.

    Entries stay for ever, also of members that have gone, so a key is never given twice. New members get the keys
    behind the largest one, dense and in the order of ``order_by``. Only new members are sorted and numbered.
    """
    fresh = _known(members.select(*order_by).distinct(), registry, name, order_by, "left_anti")
    largest = registry.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    numbered = dense_key(fresh, name, order_by).withColumn(name, F.col(name) + F.lit(largest))
    return registry.select(name, *order_by).unionByName(numbered)


def registered_key(df: DataFrame, registry: DataFrame, name: str, order_by: Sequence[str]) -> DataFrame:
    """Add the key of every row from a registry that knows them all."""
    return _known(df, registry, name, order_by, "inner").select(F.col("_key").alias(name), *df.columns)
