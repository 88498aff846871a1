"""The physical plan of the fact over stored tables, with broadcasts by size switched off."""

import pytest

from medalstar.plans import gold
from medalstar.plans.warehouse import FACT, MODELS, Warehouse
from medalstar.sources.samples import bronze_tables
from tests.support import physical_plan


@pytest.fixture(scope="module")
def fact_plan(spark):
    import tempfile

    store = Warehouse(spark, bronze_tables(spark, "/root/testdata/sf0.001"), tempfile.mkdtemp(prefix="run-"))
    inputs = [store.table(name) for name in MODELS[FACT][0]]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return physical_plan(gold.fct_participant_match_by_month(*inputs))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_participants_are_shuffled_for_team_player_and_month_only(fact_plan):
    lines = fact_plan.split("\n")
    scan = next(i for i, l in enumerate(lines) if "FileScan" in l and "perk_keystone" in l)
    depth, shuffles = lines[scan].index("FileScan"), []
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if at < depth:
            depth = at
            if "Exchange" in line:
                shuffles.append(line)
    assert len(shuffles) == 3
    assert "match_id" in shuffles[0] and "puuid" in shuffles[1] and "REBALANCE" in shuffles[2]


def test_image_addresses_come_after_the_last_shuffle(fact_plan):
    above, below = fact_plan.split("REBALANCE_PARTITIONS", 1)
    assert "champion_image_url" in above
    assert "http" not in below


def test_only_needed_columns_are_read(fact_plan):
    scan = next(l for l in fact_plan.split("\n") if "FileScan" in l and "perk_keystone" in l)
    assert "game_creation" not in scan and "perk_shard_flex" not in scan


def test_the_measured_queue_dimension_is_broadcast_before_the_shuffles(fact_plan):
    assert fact_plan.rindex("SortMergeJoin [match_id") < fact_plan.index("BroadcastHashJoin [queue_id")
