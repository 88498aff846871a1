import random
import re

from pyspark.sql import functions as F

from medalstar.operators.keys import ascending
from medalstar.operators.packing import Packing
from medalstar.plans import silver
from tests.support import bronze_rows, physical_plan, rows_of

VALUES = [None, -(2**63), -1, 0, 1, 65531, 65532, 65533, 65534, 65535, 65536, 2**40, 2**63 - 1]
KINDS = ["bigint", "boolean", "bigint", "bigint", "boolean", "bigint", "bigint", "bigint", "bigint", "boolean"]


def odd_rows(spark, n):
    rng = random.Random(5)
    some = lambda kind: rng.choice([None, False, True] if kind == "boolean" else VALUES)
    rows = [[0 if kind == "bigint" else True for kind in KINDS] for _ in range(n)]
    for row in rows:
        for place in rng.sample(range(len(KINDS)), rng.randint(0, 4)):
            row[place] = some(KINDS[place])
    schema = ", ".join(f"c{i} {kind}" for i, kind in enumerate(KINDS))
    return spark.createDataFrame([("s", *row, rng.choice(["a", None]), 7) for row in rows], f"name string, {schema}, tail string, alone bigint")


def test_packed_rows_keep_their_values_and_their_order(spark):
    df = odd_rows(spark, 400)
    packing = Packing(df.schema)
    packed = packing.pack(df)
    assert packed.columns == ["name", "_packed0_0", "_packed0_1", "_packed0_2", "_packed0_whole", "tail", "alone"]
    assert packed.filter("_packed0_whole is null").count() > 20
    restored = packing.unpack(packed)
    assert restored.schema.simpleString() == df.schema.simpleString()
    assert rows_of(restored) == rows_of(df)
    in_order = packing.unpack(packed.orderBy(*ascending(packed.columns)).coalesce(1)).collect()
    assert in_order == df.orderBy(*ascending(df.columns)).collect()


def test_kept_columns_and_short_runs_stay(spark):
    df = odd_rows(spark, 5)
    packing = Packing(df.schema, ["c5"])
    assert packing.pack(df).columns == df.columns and rows_of(packing.unpack(packing.pack(df))) == rows_of(df)


def test_repeated_ingests_are_sorted_and_shuffled_packed(spark):
    key = {"match_id": "M", "participant_id": 1}
    rows = bronze_rows(spark, "matches_participants", [
        {**key, "gold_earned": 80_000, "vision_score": 1}, {**key, "gold_earned": 70_000, "vision_score": 9},
        {**key, "gold_earned": None, "vision_score": 0}, {**key, "gold_earned": 10, "ingest_ts": "2024-01-01T00:00:00"},
        {**key, "participant_id": 2, "kills": -3, "win": None}, {**key, "participant_id": 2, "kills": 4, "win": None},
        {**key, "participant_id": 3, "first_blood_kill": None}, {**key, "participant_id": 3, "first_blood_kill": True},
    ])
    newest = silver.stg_matches_participants(rows, ["match_id", "participant_id"])
    assert rows_of(newest, "participant_id", "gold_earned", "vision_score", "kills", "win", "first_blood_kill") == [
        (1, 70_000, 9, 0, False, False), (2, 0, 0, -3, None, False), (3, 0, 0, 0, False, True)]
    plan = physical_plan(newest.select(F.col("match_id"), "kills"))
    assert re.search(r"_packed0_0#\d+L ASC", plan) and not re.search(r"gold_earned#\d+L ASC", plan)
