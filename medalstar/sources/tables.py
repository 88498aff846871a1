"""Parquet scans, table sinks and storage profiles."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalstar.functions.scalars import month_key
from medalstar.operators.joins import broadcast_if_small
from medalstar.operators.keys import top_n_per_key
from medalstar.session import new_shared_folder, remove_folder
from medalstar.sources.versions import new_version, release_versions, write_files, write_version

MONTH = "game_month"
LOAD_STATUS = "table_name string, row_count bigint, error string"


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet folder with a declared schema: no inference, no file footer reads up front."""
    return spark.read.schema(schema).parquet(path)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of several tables in one job."""
    legs = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
            for n, df in tables.items()]
    total = legs[0]
    for leg in legs[1:]:
        total = total.unionByName(leg)
    return total


def _storage(spark: SparkSession, table: str) -> tuple:
    """Schema and bucketing of a stored table."""
    buckets = spark._jsparkSession.sessionState().catalog().getTableMetadata(
        spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(table)).bucketSpec().toString()
    return spark.table(table).schema, buckets


def versions_folder(spark: SparkSession, table: str) -> str:
    """Where the versions of a table that ``replace_table`` writes are."""
    database, _, name = table.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/{name}.versions"


def replace_table(
    df: DataFrame, table: str, bucket_by: Sequence[str] = (), buckets: int = 0, keep: int = 2, in_place: bool = False,
) -> None:
    """Create or fully replace a Parquet table, optionally bucketed for co-located joins.

    ``in_place`` tells that a task's rows belong to few buckets already, so they are not shuffled for the write.

    The rows are written as a new version; then the table's location is switched to it in one step of the catalog. A
    failed write leaves the table as it is, and whoever reads during the switch sees the old rows or the new ones,
    all of them. ``keep`` versions stay for such readers. Only where columns or bucketing change is the entry of the
    catalog exchanged, by two steps without any data; files are never renamed.
    """
    spark = df.sparkSession
    folder, fresh = versions_folder(spark, table), f"{table}__{uuid.uuid4().hex}"
    path = new_version(spark, folder)
    writer = df.write.format("parquet")
    if bucket_by:
        # One writing task per bucket, so each bucket is one file.
        writer = (df if in_place else df.repartition(buckets, *bucket_by)).write.format("parquet")
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    try:
        writer.option("path", path).saveAsTable(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        remove_folder(spark, path)
        raise
    if spark.catalog.tableExists(table) and _storage(spark, table) == _storage(spark, fresh):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.sql(f"DROP TABLE {fresh}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    spark.catalog.refreshTable(table)
    release_versions(spark, folder, keep)


def replace_files(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] = write_files, keep: int = 2) -> DataFrame:
    """Replace the table stored in versions below ``path``: a failed write leaves the old rows, see ``versions``.

    ``keep`` versions stay, so that readers of the last one can finish. Returns the new rows.
    """
    spark = df.sparkSession
    fresh = write_version(df, path, write)
    release_versions(spark, path, keep)
    return scan(spark, fresh, df.schema)


def append_rows(df: DataFrame, table: str) -> None:
    """Append to an existing table, matching columns by name."""
    df.select(df.sparkSession.table(table).columns).write.insertInto(table)


def create_table(spark: SparkSession, table: str, schema: T.StructType | str, partition_by: Sequence[str] = ()) -> None:
    """Empty Parquet table with explicit column types."""
    writer = spark.createDataFrame([], schema).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def insert_from_files(spark: SparkSession, path: str, schema: T.StructType, table: str) -> None:
    """Insert raw Parquet files that lie outside the warehouse into a managed table."""
    append_rows(scan(spark, path, schema), table)


def load_tables(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, T.StructType],
                database: str) -> DataFrame:
    """Replace one table per path. A failing table does not stop the next one.

    Rows are counted while they are written. Returns (table_name, row_count, error); the caller
    decides, see ``raise_on_error``.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    status: list[tuple[str, int | None, str | None]] = []
    for name, path in paths.items():
        seen = Observation(f"load_{name}")
        try:
            df = scan(spark, path, schemas[name]).observe(seen, F.count(F.lit(1)).alias("rows"))
            replace_table(df, f"{database}.{name}")
            status.append((name, seen.get["rows"], None))
        except Exception as error:  # noqa: BLE001 - reported per table
            status.append((name, None, f"{type(error).__name__}: {error}".splitlines()[0]))
    return spark.createDataFrame(status, LOAD_STATUS)


def raise_on_error(status: DataFrame) -> None:
    failed = [f"{r.table_name}: {r.error}" for r in status.filter(F.col("error").isNotNull()).collect()]
    if failed:
        raise RuntimeError("; ".join(failed))


def gather_months(df: DataFrame, ts: Column | str) -> DataFrame:
    """Add the month of ``ts`` and bring its rows together for writing.

    The rebalance leaves few files per month, and AQE splits a month that is too large for one
    task. Rows come out sorted by month, so the writer need not sort them again.
    """
    return df.withColumn(MONTH, month_key(ts)).hint("rebalance", MONTH).sortWithinPartitions(MONTH)


def write_months(df: DataFrame, path: str, keep_other_months: bool = False) -> None:
    """Replace a Parquet folder partitioned by month; ``df`` comes from ``gather_months``.

    ``keep_other_months`` replaces only the months present in ``df``.
    """
    mode = "dynamic" if keep_other_months else "static"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(MONTH).parquet(path)


def upsert_months(
    changes: DataFrame, path: str, keys: Sequence[str], ts: Column | str, newest: Sequence[Column], moves: bool = False,
) -> list[str | None]:
    """Merge an ingest into a folder partitioned by month; returns the months that were rewritten.

    Of rows with one key the first in the order of ``newest`` counts. A stored row with the key is replaced if any of its
    other columns differs, told by 128 bits of hash; rows that are stored as they are change nothing. Only
    months with changed rows are rewritten, so an ingest that comes twice rewrites none, and other months keep their files.
    Months the ingest does not touch are not read, unless ``moves`` says that the month of a stored key may change: then
    their keys are, and nothing else. Keys and months may be NULL. A month is exchanged when its new rows are
    written in full.
    """
    spark = changes.sparkSession
    incoming, staged = new_shared_folder(spark, "incoming"), new_shared_folder(spark, "changed")
    one = top_n_per_key(changes.withColumn(MONTH, month_key(ts)), keys, newest)
    one.write.parquet(incoming)
    news = scan(spark, incoming, one.schema)
    stored = scan(spark, path, one.schema) if _is_folder(spark, path) else spark.createDataFrame([], one.schema)
    data = [c for c in one.columns if c not in (*keys, MONTH)]
    digest = [F.xxhash64(F.lit(seed), *data, *[F.col(c).isNull() for c in data]).alias(f"_h{seed}") for seed in (1, 2)]
    known = stored.filter(_in_months(_months(news))).select(*keys, F.col(MONTH).alias("_month"), *digest)
    if moves:
        elsewhere = stored.filter(~F.coalesce(_in_months(_months(news)), F.lit(False)))
        known = known.unionByName(elsewhere.select(*keys, F.col(MONTH).alias("_month")), allowMissingColumns=True)
    known = known.withColumn("_stored", F.lit(True))
    given = news.select("*", *[h.alias(f"_n{i}") for i, h in enumerate(digest, 1)])
    joined = given.join(known.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "_month", "_h1", "_h2", "_stored"),
                        reduce(Column.__and__, (given[c].eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys))), "left")
    equal = F.col("_stored").isNotNull() & F.col("_month").eqNullSafe(F.col(MONTH)) & F.col("_h1").eqNullSafe(
        F.col("_n1")) & F.col("_h2").eqNullSafe(F.col("_n2"))
    joined.filter(~equal).select(*one.columns, "_month", "_stored").write.parquet(staged)
    changed = spark.read.parquet(staged)
    left = changed.filter("_stored").select(F.col("_month").alias(MONTH))
    touched = _months(changed.select(MONTH).unionByName(left))
    rows = changed.select(one.columns)
    if touched:
        gone = rows.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
        kept = stored.filter(_in_months(touched))
        kept = kept.join(gone, reduce(Column.__and__, (kept[c].eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys))), "left_anti")
        # A month that loses its last row gets no new files to take the place of the old ones.
        emptied = set(touched) - set(_months(rows)) - set(_months(kept)) if moves else set()
        write_months(kept.unionByName(rows).hint("rebalance", MONTH).sortWithinPartitions(MONTH), path, keep_other_months=True)
        for month in emptied:
            remove_folder(spark, f"{path}/{MONTH}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}")
    for folder in (incoming, staged):
        remove_folder(spark, folder)
    return sorted(touched, key=lambda m: (m is None, m or ""))


def _months(df: DataFrame) -> list[str | None]:
    return [r[0] for r in df.select(MONTH).distinct().collect()]


def _in_months(months: Sequence[str | None]) -> Column:
    """A filter that prunes partitions."""
    named = F.col(MONTH).isin([m for m in months if m is not None])
    return named | F.col(MONTH).isNull() if None in months else named


def _is_folder(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def read_period(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows with start <= ts < end of a month-partitioned table.

    The month range is derived here, because a filter on the timestamp alone prunes no partition.
    """
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    months = F.col(MONTH).between(month_key(first), month_key(last))
    return df.filter(months & (F.col(ts) >= first) & (F.col(ts) < last))


def read_dates(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows of a month-partitioned table on the days of a filtered date dimension (``date_key``, ``calendar_date``).

    The months of those days join as well: they are the partition column, so the scan learns at run time, from the
    dimension, which months to read.
    """
    days = dates.select("date_key", month_key(F.col("calendar_date")).alias(MONTH))
    return df.join(broadcast_if_small(days), ["date_key", MONTH], "left_semi")


def partition_profile(df: DataFrame, by: str, value: str) -> DataFrame:
    """Rows and value range per partition."""
    return df.groupBy(by).agg(
        F.count("*").alias("rows"), F.min(value).alias("min_value"), F.max(value).alias("max_value")
    )


def file_profile(df: DataFrame, value: str) -> DataFrame:
    """Rows and value range per file of a file scan."""
    return partition_profile(df.withColumn("file_path", F.col("_metadata.file_path")), "file_path", value)
