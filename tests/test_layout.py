"""What scans can skip: footers, dimension pruning, clustered files; and sets kept as bitmaps."""

import glob
import random
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, TimestampType

from medalstar.operators import bitmaps
from medalstar.sources import clustering, footers, tables
from tests.support import physical_plan, rows_of


def test_footers_agree_with_a_scan(spark, folder):
    rows = [(i, None if i % 3 == 0 else f"s{i:03d}", i / 7, date(2025, 1, 1 + i % 28)) for i in range(-50, 50)]
    df = spark.createDataFrame(rows, "i bigint, s string, d double, day date").repartition(4).sortWithinPartitions("i")
    df.write.option("parquet.block.size", "1024").parquet(f"{folder}/t")
    spark.createDataFrame([(7, None, 0.5, None)], df.schema).write.mode("append").parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    for column in ("i", "s", "d", "day"):
        scanned = tables.file_profile(stored, column).withColumn("file_path", F.regexp_extract("file_path", "[^/]+$", 0))
        found = footers.footer_profile(spark, f"{folder}/t", column, df.schema[column].dataType)
        assert found.agg(F.bool_and("known")).first()[0]
        assert rows_of(found.filter("rows > 0").select(F.regexp_extract("file_path", "[^/]+$", 0), "rows", "min_value", "max_value")) == rows_of(
            scanned, "file_path", "rows", "min_value", "max_value")
        assert found.agg(F.sum("nulls")).first()[0] == stored.filter(F.col(column).isNull()).count()


def test_footers_are_read_without_row_groups(spark, folder):
    spark.range(1000).coalesce(1).write.parquet(f"{folder}/t")
    (file,) = glob.glob(f"{folder}/t/*.parquet")
    column = pq.read_metadata(file).row_group(0).column(0)
    with open(file, "r+b") as out:  # only the footer is left whole
        out.seek(4)
        out.write(b"\0" * column.total_compressed_size)
    (crc,) = glob.glob(f"{folder}/t/.*.parquet.crc")
    with open(crc, "wb") as out:  # without its checksums
        out.write(b"")
    row = footers.footer_profile(spark, f"{folder}/t", "id", LongType()).first()
    assert (row["rows"], row["min_value"], row["max_value"], row["known"]) == (1000, 0, 999, True)


def test_footers_tell_what_they_do_not_know(spark, folder):
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        spark.createDataFrame([(datetime(2025, 1, 1), 1), (None, 2)], "at timestamp, n int").coalesce(1).write.parquet(f"{folder}/old/m=1")
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    row = footers.footer_profile(spark, f"{folder}/old", "at", TimestampType()).first()
    assert (row["rows"], row["min_value"], row["known"]) == (2, None, False)
    pq.write_table(pa.table({"n": pa.array([5], pa.int32())}), f"{folder}/old/m=1/later.parquet")  # lacks the column
    later = footers.footer_profile(spark, f"{folder}/old", "at", TimestampType()).filter("file_path LIKE '%later%'").first()
    assert (later["rows"], later["nulls"], later["known"]) == (1, 1, True)


def test_the_dimension_prunes_months(spark, folder):
    days = spark.sql("SELECT explode(sequence(date'2025-01-01', date'2025-12-31')) AS calendar_date").withColumn(
        "date_key", F.date_format("calendar_date", "yyyyMMdd").cast("int"))
    fact = days.select("date_key", F.date_format("calendar_date", "yyyy-MM").alias(tables.MONTH), F.lit(1).alias("n"))
    tables.write_months(fact, f"{folder}/fact")
    stored = spark.read.parquet(f"{folder}/fact")
    found = tables.read_dates(stored, days.filter("day(calendar_date) = 3 AND month(calendar_date) > 10"))
    assert rows_of(found, "date_key") == [(20251103,), (20251203,)]
    assert "dynamicpruning" in physical_plan(found)


def test_bitmaps_hold_what_the_rows_hold(spark):
    rng = random.Random(2)
    pool = [0, 1, 2, 32767, 32768, 32769, 65536, 65537, 10**7, 2**31 + 5, -1, -5, -32767, -32768, -40000]
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *pool]), rng.choice([None, *pool[:4]])) for _ in range(80)]
    df = spark.createDataFrame(rows, "m string, x bigint, y bigint")
    maps = bitmaps.id_bitmaps(df, ["x", "y"], ["m"])
    held = {v for _, x, y in rows for v in (x, y) if v is not None}
    assert rows_of(bitmaps.ids(maps, "id")) == sorted(((v,) for v in held), key=repr)
    expected = {m: len({v for n, x, y in rows if n == m for v in (x, y) if v is not None}) for m in ("a", "b", None)}
    assert dict(rows_of(bitmaps.id_counts(maps, ["m"]))) == expected
    assert bitmaps.id_counts(maps).first()[0] == len(held)
    assert bitmaps.ids(bitmaps.id_bitmaps(df.limit(0), ["x"]), "id").count() == 0


@pytest.mark.parametrize("column, value", [("player", "p017"), ("champion", 33), ("day", 250)])
def test_clustered_files_can_be_skipped_by_any_column(spark, folder, column, value):
    """A filter on any of three columns leaves about half of 64 files or less; after a sort by one it is all for the others."""
    n = 40_000
    df = spark.range(n, numPartitions=4).select(
        "id", F.format_string("p%03d", F.pmod(F.xxhash64("id"), F.lit(300))).alias("player"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(160)).alias("champion"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(365)).alias("day"))
    clustering.cluster_rows(df, ["player", "champion", "day"], 64).write.parquet(f"{folder}/t")
    profile = footers.footer_profile(spark, f"{folder}/t", column, df.schema[column].dataType)
    hit = profile.filter(F.lit(value).between(F.col("min_value"), F.col("max_value"))).agg(F.count("*"), F.sum("rows")).first()
    assert profile.count() == 64 and hit[1] < 0.55 * n
    assert spark.read.parquet(f"{folder}/t").filter(F.col(column) == value).count() == df.filter(F.col(column) == value).count()


def test_clustering_cuts_a_hot_player_by_the_others(spark, folder):
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("player"),
                                  (F.col("id") % 100).alias("champion"), F.lit(None).cast("date").alias("day"))
    clustering.cluster_rows(df, ["player", "champion", "day"], 10).write.parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    sizes = [r[0] for r in stored.groupBy(F.input_file_name()).count().select("count").collect()]
    assert len(sizes) >= 9 and max(sizes) < 2000 and stored.count() == 9000
    files = footers.footer_profile(spark, f"{folder}/t", "champion", LongType()).filter(F.lit(50).between(F.col("min_value"), F.col("max_value")))
    assert files.count() < 8
    empty = clustering.cluster_rows(df.limit(0), ["player"], 4)
    assert empty.count() == 0
    with pytest.raises(ValueError):
        clustering.cluster_rows(df, [], 4)
