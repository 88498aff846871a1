"""Declarative data checks. A check passes when it finds zero failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Checks:
    """The checks of one table."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] | None = None
    # foreign key -> (parent table, parent key)
    relationships: Mapping[str, tuple[str, str]] | None = None

    def columns(self) -> list[str]:
        """The columns that the checks look at."""
        return list(dict.fromkeys([*self.not_null, *self.unique, *(self.accepted or {}), *(self.relationships or {})]))

    def count(self) -> int:
        return len(self.not_null) + len(self.unique) + len(self.accepted or {}) + len(self.relationships or {})


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failures): NULL rows of every listed column, in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])
    return counts.select(F.inline(pairs))


def duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; keys holding a NULL pass."""
    present = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return df.filter(present).groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def unaccepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the accepted list, with their row count; NULL passes."""
    return df.filter(~F.col(column).isin(list(values))).groupBy(column).agg(F.count("*").alias("rows"))


def report(tables: Mapping[str, DataFrame], suites: Mapping[str, Checks]) -> DataFrame:
    """One row per check: table_name, column_name, test_name, failures, passed.

    NULL checks and broken references count rows; the other two count offending values.

    Every table is scanned once. A row gives one (check, value) per check it matters to, a parent's
    row one for each reference to it; one aggregate by (check, value) then tells how often a value
    occurs and whether a parent has it, so references need no join. A hot value collapses before the
    shuffle. Values are compared as text, which suits whole numbers, text and dates.
    """
    checks: list[tuple[str, str, str]] = []
    found: dict[str, list[Column]] = {}

    def look(table: str, check: int, matters: Column, value: Column, parent: bool = False) -> None:
        found.setdefault(table, []).append(F.when(matters, F.struct(
            F.lit(check).alias("check"), value.cast("string").alias("value"),
            F.lit(0 if parent else 1).cast("bigint").alias("rows"), F.lit(parent).alias("parent"))))

    def check(table: str, column: str, test: str) -> int:
        checks.append((table, column, test))
        return len(checks) - 1

    for name, suite in suites.items():
        for c in suite.not_null:
            look(name, check(name, c, "not_null"), F.col(c).isNull(), F.lit(None))
        for c in suite.unique:
            look(name, check(name, c, "unique"), F.col(c).isNotNull(), F.col(c))
        for c, values in (suite.accepted or {}).items():
            look(name, check(name, c, "accepted_values"), ~F.col(c).isin(list(values)), F.col(c))
        for c, (parent, key) in (suite.relationships or {}).items():
            number = check(name, c, "relationships")
            look(name, number, F.col(c).isNotNull(), F.col(c))
            look(parent, number, F.col(key).isNotNull(), F.col(key), parent=True)

    values = reduce(DataFrame.unionByName, [
        tables[name].select(F.inline(F.array(*looks))).filter(F.col("check").isNotNull()) for name, looks in found.items()
    ])
    counted = values.groupBy("check", "value").agg(F.sum("rows").alias("rows"), F.max("parent").alias("parent"))
    spark = counted.sparkSession
    listed = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("check"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                 F.lit(test).alias("test_name")) for i, (table, column, test) in enumerate(checks)])))
    test = F.col("test_name")
    failures = (
        F.when(test == "not_null", F.col("rows"))
        .when(test == "unique", (F.col("rows") > 1).cast("bigint"))
        .when(test == "accepted_values", F.lit(1).cast("bigint"))
        .when(~F.col("parent"), F.col("rows"))
    )
    # The list of checks is broadcast: as many rows as are declared.
    totals = counted.join(F.broadcast(listed.select("check", "test_name")), "check").groupBy("check").agg(
        F.sum(failures).alias("failures"))
    return listed.join(F.broadcast(totals), "check", "left").select(
        "table_name", "column_name", "test_name", F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures")
    ).withColumn("passed", F.col("failures") == 0)
