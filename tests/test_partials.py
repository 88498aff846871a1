"""Monthly partials: equal to the full answers, refreshed by month."""

import os
import re

import pytest
from pyspark.sql import functions as F

from medalstar.plans import marts, partials
from medalstar.sources.tables import MONTH
from tests.support import physical_plan, rows_of

FACT = ("match_id string, team_id bigint, puuid string, player_key bigint, champion_key bigint, champion_name string, "
        "queue_patch_key bigint, side string, team_position string, win boolean, kda double, gold_per_minute double, "
        "cs_per_minute double, vision_score bigint, damage_to_champions bigint, team_first_blood boolean, "
        "team_first_dragon boolean, team_first_baron boolean, team_dragon_kills bigint, team_baron_kills bigint, game_month string")
PATCHES = "queue_patch_key bigint, patch_major string"


def fact_rows(months, shift=0):
    rows = []
    for m, month in enumerate(months):
        for i in range(24):
            team = 100 * (1 + i % 2)
            rows.append((f"m{m}-{i // 6}", team, f"p{i % 5}", None if i % 7 == 0 else i % 5, i % 3, f"c{i % 3}", (i + m) % 3 or None,
                         None if i % 11 == 0 else "blue" if team == 100 else "red", ["TOP", "", None][i % 3],
                         None if i == 9 else (i // 6 + i + shift) % 2 == 0, i / 7 + shift, None if i % 5 == 0 else i / 3, 0.1 * i, i, i * 100,
                         i % 2 == 0, None, (i // 6) % 2 == 0, i % 4, None if i % 6 == 0 else m, month))
    return rows


def full(spark, fact, name):
    patches = spark.createDataFrame([(1, "14.1"), (2, "14.2")], PATCHES)
    return getattr(marts, name)(fact, *([patches] if name == "champion_winrate_by_patch" else [])), patches


@pytest.mark.parametrize("name", sorted(partials.MARTS))
def test_partials_add_up_to_the_whole(spark, folder, name):
    fact = spark.createDataFrame(fact_rows(["2025-01", "2025-02", None, "2025-03"]), FACT)
    expected, patches = full(spark, fact, name)
    combined = partials.combine(name, partials.partial(name, fact), patches)
    assert combined.dtypes == expected.dtypes and rows_of(combined) == rows_of(expected)
    empty = partials.combine(name, partials.partial(name, fact.limit(0)), patches)
    assert empty.dtypes == expected.dtypes and empty.count() == 0


def test_a_late_month_replaces_its_partial_only(spark, folder):
    path = f"{folder}/fact"
    months = ["2025-01", "2025-02", None]
    spark.createDataFrame(fact_rows(months), FACT).write.partitionBy(MONTH).parquet(path)
    partials.refresh(spark.read.parquet(path), folder)
    names = sorted(partials.MARTS)

    def files():
        return {(n, d): sorted(os.listdir(f"{folder}/partials/{n}/{d}")) for n in names for d in os.listdir(f"{folder}/partials/{n}") if "=" in d}

    before = files()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:  # February comes anew, with other results
        late = [r for r in fact_rows(months, shift=1) if r[-1] == "2025-02"]
        spark.createDataFrame(late, FACT).write.mode("overwrite").partitionBy(MONTH).parquet(path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    fact = spark.read.parquet(path)
    partials.refresh(fact, folder, ["2025-02"])
    after = files()
    assert {k for k in after if after[k] != before[k]} == {(n, "game_month=2025-02") for n in names}
    for name in names:
        expected, patches = full(spark, fact, name)
        assert rows_of(partials.combine(name, partials.stored(spark, folder, name), patches)) == rows_of(expected)
        partly = partials.stored(spark, folder, name).filter(F.col(MONTH) >= "2025-02")
        assert rows_of(partials.combine(name, partly, patches)) == rows_of(full(spark, fact.filter(F.col(MONTH) >= "2025-02"), name)[0])
    plan = physical_plan(partials.partial("role_analysis", fact.filter(F.col(MONTH).isin(["2025-02"]))))
    assert re.search(r"PartitionFilters: \[[^\]]*game_month", plan)
    partials.refresh(fact.filter(f"{MONTH} IS NOT NULL"), folder, [None, "2025-01"])  # rows without time are gone
    assert {d for _, d in files()} == {"game_month=2025-01", "game_month=2025-02"}
