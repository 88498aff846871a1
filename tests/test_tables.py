import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medalstar.sources import tables
from tests.support import physical_plan, rows_of

SCHEMA = "id bigint, name string"


@pytest.fixture
def database(spark, request):
    name = f"db_{abs(hash(request.node.name))}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_scan_uses_the_declared_schema(spark, folder):
    spark.createDataFrame([(1, "a")], SCHEMA).write.parquet(f"{folder}/t")
    schema = StructType.fromDDL("name string, later double")
    assert rows_of(tables.scan(spark, f"{folder}/t", schema)) == [("a", None)]


def test_scan_pushes_filters_and_columns_down(spark, folder):
    spark.createDataFrame([(1, "a")], SCHEMA).write.parquet(f"{folder}/t")
    plan = physical_plan(tables.scan(spark, f"{folder}/t", StructType.fromDDL(SCHEMA)).filter("id > 5").select("id"))
    assert "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_replace_create_append_insert(spark, folder, database):
    table = f"{database}.t"
    tables.replace_table(spark.createDataFrame([(1, "a")], SCHEMA), table)
    tables.replace_table(spark.createDataFrame([(2, "b", True)], SCHEMA + ", extra boolean"), table)
    assert rows_of(spark.table(table)) == [(2, "b", True)]
    tables.create_table(spark, table, SCHEMA)
    assert spark.table(table).count() == 0
    tables.append_rows(spark.createDataFrame([("n", 7)], "name string, id bigint"), table)
    spark.createDataFrame([(8, "raw")], SCHEMA).write.parquet(f"{folder}/raw")
    tables.insert_from_files(spark, f"{folder}/raw", StructType.fromDDL(SCHEMA), table)
    assert rows_of(spark.table(table)) == [(7, "n"), (8, "raw")]


def test_partitioned_table(spark, database):
    table = f"{database}.events"
    tables.create_table(spark, table, "data string, day date", ["day"])
    tables.append_rows(spark.sql("select date'2025-01-01' as day, 'x' as data"), table)
    plan = physical_plan(spark.table(table).filter("day >= date'2025-02-01'"))
    assert "PartitionFilters: [isnotnull(day" in plan


def test_load_reports_each_table(spark, folder, database):
    schemas = {n: StructType.fromDDL(SCHEMA) for n in ("good", "missing", "last")}
    for name in ("good", "last"):
        spark.range(3).selectExpr("id", "'x' as name").write.parquet(f"{folder}/{name}")
    status = tables.load_tables(spark, {n: f"{folder}/{n}" for n in schemas}, schemas, database)
    found = {r["table_name"]: (r["row_count"], r["error"] is None) for r in status.collect()}
    assert found == {"good": (3, True), "missing": (None, False), "last": (3, True)}
    assert spark.table(f"{database}.last").count() == 3
    with pytest.raises(RuntimeError, match="missing"):
        tables.raise_on_error(status)
    tables.raise_on_error(status.filter("table_name <> 'missing'"))


def month_rows(spark, *days):
    return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, at string").withColumn(
        "at", F.col("at").cast("timestamp")
    )


def test_month_partitions_prune_and_replace(spark, folder):
    path = f"{folder}/fact"

    def write(*days, **options):
        tables.write_months(tables.gather_months(month_rows(spark, *days), "at"), path, **options)

    write("2025-01-04", "2025-01-31 23:59:59.9", "2025-02-01")
    stored = spark.read.parquet(path)
    january = tables.read_period(stored, "at", "2025-01-01", "2025-02-01")
    assert rows_of(january, "id") == [(0,), (1,)]
    assert "PartitionFilters: [isnotnull(game_month" in physical_plan(january)
    assert rows_of(stored.groupBy("game_month").count()) == [("2025-01", 2), ("2025-02", 1)]

    write("2025-02-07", "2025-02-08", keep_other_months=True)
    assert rows_of(spark.read.parquet(path).groupBy("game_month").count()) == [("2025-01", 2), ("2025-02", 2)]
    write("2025-03-07")
    assert rows_of(spark.read.parquet(path).groupBy("game_month").count()) == [("2025-03", 1)]


def test_a_hot_month_is_split_over_tasks(spark, folder):
    # One month holds nearly everything; with a small target size it must not end in one file.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(40000, numPartitions=8).select(
            "id", F.when(F.col("id") < 100, "2025-01-01").otherwise("2025-02-01").cast("timestamp").alias("at"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
        )
        tables.write_months(tables.gather_months(rows, "at"), f"{folder}/hot")
        files = tables.file_profile(spark.read.parquet(f"{folder}/hot"), "id")
        per_month = files.groupBy(F.regexp_extract("file_path", "game_month=([0-9-]+)", 1).alias("m")).count()
        found = dict(rows_of(per_month))
        assert found["2025-02"] > 3 and found["2025-01"] == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_profiles(spark, folder):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "p string, v int")
    assert rows_of(tables.partition_profile(df, "p", "v")) == [("a", 2, 1, 3), ("b", 1, 2, 2)]
    df.repartition(1).write.parquet(f"{folder}/files")
    profile = tables.file_profile(spark.read.parquet(f"{folder}/files"), "v").collect()
    assert [(r["rows"], r["min_value"], r["max_value"]) for r in profile] == [(3, 1, 3)]
    assert profile[0]["file_path"].endswith(".parquet")


def test_row_counts(spark):
    frames = {"x": spark.range(3), "y": spark.range(0)}
    assert rows_of(tables.row_counts(frames)) == [("x", 3), ("y", 0)]


def test_bucketed_tables_join_without_a_shuffle(spark, database):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("left", "right"):
            df = spark.range(100).selectExpr("id as match_id", "id % 2 as team_id", f"id as {name}_value")
            tables.replace_table(df, f"{database}.{name}", ["match_id", "team_id"], 4)
        joined = spark.table(f"{database}.left").join(spark.table(f"{database}.right"), ["match_id", "team_id"], "left")
        assert "Exchange" not in physical_plan(joined)
        assert joined.filter("left_value = right_value").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
