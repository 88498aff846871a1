"""What a question computes and how it is spread, as its tables grow."""

import json
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medalstar import schemas
from medalstar.checks import queries, refresh  # noqa: F401 - registers its queries
from medalstar.operators import quality
from medalstar.plans.suites import SUITES
from medalstar.plans.warehouse import FACT, Warehouse
from medalstar.session import bytes_of
from medalstar.sources import documents, match_texts, samples
from medalstar.sources.tables import MONTH
from tests.support import bronze_rows, optimized_plan, physical_plan, rows_of

SF_DIR = "/root/testdata/sf0.001"


def test_bytes_of_files_and_folders(spark, folder):
    spark.range(10).write.parquet(f"{folder}/rows")
    assert bytes_of(spark, f"{folder}/rows") > 0
    assert bytes_of(spark, f"{folder}/absent") == 0
    assert bytes_of(spark, f"{folder}/rows", f"{folder}/rows") == 2 * bytes_of(spark, f"{folder}/rows")


def test_documents_are_spread_over_more_tasks_the_more_there_are(spark, monkeypatch):
    at_once = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(samples, "bytes_of", lambda *_: 20 * 1024 * 1024)
    many = samples.match_documents.__wrapped__(spark, SF_DIR)
    assert many.rdd.getNumPartitions() > 10 * at_once
    monkeypatch.setattr(samples, "bytes_of", lambda *_: 1)
    few = samples.match_documents.__wrapped__(spark, SF_DIR)
    assert few.rdd.getNumPartitions() == at_once
    assert rows_of(few) == rows_of(many)


def test_shuffles_get_more_partitions_the_larger_the_tables(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        monkeypatch.setattr(queries, "bytes_of", lambda *_: 10**9)
        queries.QUERIES["limit_n"](spark, SF_DIR)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_question_about_documents_writes_nothing(spark, monkeypatch):
    monkeypatch.setattr(queries, "new_shared_folder", lambda *_: 1 / 0)
    assert queries.flatten_teams(spark, SF_DIR).count() == 2 * spark.read.parquet(f"{SF_DIR}/orders.parquet").count()


def test_texts_that_cannot_hold_a_value_are_told(spark):
    texts = ['{"puuid": "P_42"}', '{"puuid": "P\\u005f42"}', '{"puuid": "P_4"}', '{"puuid": 42}']
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    assert rows_of(rows.filter(documents.may_hold("value", "P_42"))) == [(t,) for t in sorted(texts[:2], key=lambda t: repr((t,)))]
    # A number may be spelled otherwise than the string it is read as.
    assert rows.filter(documents.may_hold("value", "42")).count() == 4


def test_player_matches_finds_escaped_names_and_skips_other_texts(spark):
    everyone = queries.bronze.player_matches(queries.matches(spark, SF_DIR), "P_42")
    assert rows_of(queries.player_matches(spark, SF_DIR)) == rows_of(everyone)
    assert "Contains(value" in optimized_plan(queries.player_matches(spark, SF_DIR))


def fact_bronze(spark):
    lines = [{"match_id": f"M{i % 4}", "participant_id": i, "team_id": 100, "puuid": f"P{i % 3}", "queue_id": 420, "game_version": "14.1",
              "game_start_timestamp": 1_700_000_000_000 + i * 10**9} for i in range(12)]
    return {
        "matches_participants": bronze_rows(spark, "matches_participants", lines),
        "matches_teams": bronze_rows(spark, "matches_teams", [{"match_id": f"M{i}", "team_id": 100} for i in (0, 1, 1, 3)]),
        "ladder": bronze_rows(spark, "ladder", [{"puuid": "P1", "platform": ""}]),
    }


def test_a_store_of_some_columns_holds_all_rows_and_no_other_columns(spark, folder):
    whole = Warehouse(spark, fact_bronze(spark), f"{folder}/whole").table(FACT)
    store = Warehouse(spark, fact_bronze(spark), f"{folder}/some", columns={FACT: ["match_id", "player_key", MONTH]}, in_plan=queries.WIDE)
    some = store.table(FACT)
    assert some.columns == ["match_id", "player_key", MONTH]
    assert rows_of(some) == rows_of(whole, *some.columns)
    assert bytes_of(spark, f"{folder}/some/silver/stg_matches_participants") == 0
    assert set(store.build()) == set(Warehouse(spark, fact_bronze(spark), f"{folder}/all").build())


def test_questions_take_only_their_columns_of_the_fact(spark):
    for name in ("player_performance", "star_join", "side_winrate"):
        plan = optimized_plan(queries.QUERIES[name](spark, SF_DIR))
        assert "ward" not in plan and "http" not in plan, name
    stored = queries.stored_fact(spark, SF_DIR, "date_key")
    assert stored.columns == ["date_key", MONTH]
    assert stored.count() == queries.fct_participant_match(spark, SF_DIR).count()


def test_tables_by_player_are_built_only_for_questions_that_read_them(spark, folder):
    store = Warehouse(spark, fact_bronze(spark), f"{folder}/none", columns={FACT: ["match_id", MONTH]}, in_plan=queries.WIDE)
    assert store.table(FACT).count() == Warehouse(spark, fact_bronze(spark), f"{folder}/whole").table(FACT).count() == 12 + 3
    assert bytes_of(spark, store.path("dim_player"), store.path("stg_ladder")) == 0
    keys = Warehouse(spark, fact_bronze(spark), f"{folder}/keys", columns={"dim_player": ["puuid", "player_key"]}, in_plan=queries.WIDE)
    whole = Warehouse(spark, fact_bronze(spark), f"{folder}/other").table("dim_player")
    assert rows_of(keys.table("dim_player")) == rows_of(whole, "puuid", "player_key")
    assert bytes_of(spark, keys.path("stg_ladder")) == 0
    plan = optimized_plan(queries.fact(spark, SF_DIR, "match_id", "champion_key", "queue_patch_key"))
    assert "puuid" not in plan and "_platform" not in plan


def test_derived_columns_do_not_travel_with_the_rows_of_repeated_ingests(spark):
    rows = bronze_rows(spark, "matches_participants", [
        {"match_id": "M", "participant_id": 1, "kills": k, "ingest_ts": f"2025-01-0{day}T00:00:00"} for k, day in ((1, 1), (5, 2), (4, 2))])
    newest = queries.silver.stg_matches_participants(rows, queries.ID)
    assert rows_of(newest, "kills", "kda") == [(4, 4.0)]
    above, below = physical_plan(newest).split("hashpartitioning(match_id", 1)
    assert "gold_per_minute" in above and "gold_per_minute" not in below


def test_a_repeated_ingest_is_derived_once(spark):
    plan = optimized_plan(queries.dedupe_participants(spark, SF_DIR))
    assert plan.count("l_linenumber#") > 0 and "Union" not in plan


def test_rows_that_grow_before_a_sort_are_dealt_out_finer(spark):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size, None)
    try:
        spark.conf.unset(size)
        queries.dedupe_participants(spark, SF_DIR)
        finer = spark.conf.get(size)
        queries.latest_per_key(spark, SF_DIR)
        assert (finer, spark.conf.get(size)) == ("4MB", "16MB")
        spark.conf.set(size, "9MB")  # the caller's own
        queries.dedupe_participants(spark, SF_DIR)
        assert spark.conf.get(size) == "9MB"
    finally:
        spark.conf.unset(size) if before is None else spark.conf.set(size, before)


def test_texts_of_matches_are_written_by_columns_also_for_odd_keys():
    keys = pa.record_batch([pa.array([7, -13, 0, None], pa.int64()), pa.array([1000, None, 0, 0], pa.int64())], ["doc_id", "start"])
    (written,) = match_texts.writer()([keys])
    texts = written.column("value").to_pylist()
    assert texts[3] is None  # no key, no match
    seven, negative = (json.loads(text)["info"] for text in texts[:2])
    assert len(seven["participants"]) == 8 and set(schemas.PARTICIPANT_REQUIRED) <= set(seven["participants"][0])
    assert seven["gameStartTimestamp"] == 1000 and seven["gameCreation"] == -4000
    # SQL lists nobody for it, and a remainder has the sign of the key.
    assert negative["participants"] == [] and negative["queueId"] == 387
    assert "gameCreation" not in negative and "gameEndTimestamp" not in negative
    too_large = pa.record_batch([pa.array([2**62], pa.int64()), pa.array([0], pa.int64())], ["doc_id", "start"])
    with pytest.raises(OverflowError):
        list(match_texts.writer()([too_large]))


def test_documents_are_judged_and_cut_in_one_generator(spark):
    for name in ("code_label", "optional_default", "array_get_default", "struct_get_default", "reject_malformed"):
        plan = optimized_plan(queries.QUERIES[name](spark, SF_DIR))
        assert plan.count("Generate ") == 1 and "to_json" not in plan, name


def test_reasons_of_a_text_are_those_of_its_parsed_document(spark):
    texts = samples.damaged_match_documents(spark, SF_DIR)
    parsed = documents.match_rejection(documents.parse_documents(texts, "value", schemas.MATCH_DOCUMENT))
    assert rows_of(documents.match_reasons(texts, "value"), "doc_id", "reason") == rows_of(parsed, "doc_id", "reason")
    accepted = documents.accepted_matches(documents.parse_documents(texts, "value", schemas.MATCH_DOCUMENT))
    assert rows_of(documents.matches_of(texts, "value")) == rows_of(accepted, "metadata", "info")


def test_the_whole_fact_shuffles_what_its_columns_derive_from(spark):
    narrow = queries.fct_participant_match(spark, SF_DIR)
    wide = queries.fact(spark, SF_DIR, *queries.gold.FACT_COLUMNS)
    assert narrow.schema == wide.schema
    assert narrow.exceptAll(wide).isEmpty() and wide.exceptAll(narrow).isEmpty()
    above, below = physical_plan(narrow).split("hashpartitioning(puuid", 1)
    assert "vision_score" in above and "vision_score" not in below


def test_the_report_joins_lines_and_orders_once_and_reads_no_ranks_for_the_fact(spark, monkeypatch):
    taken = {}

    def report(tables, suites):
        taken.update(tables)
        return quality.report(tables, suites)

    monkeypatch.setattr(queries, "quality", SimpleNamespace(report=report))
    monkeypatch.setattr(queries, "_warehouses", {})
    queries.QUERIES["dq_report"](spark, SF_DIR)
    plan = optimized_plan(taken[FACT])
    assert "lineitem" not in plan and "l_partkey" not in plan and "league_points" not in plan
    assert set(taken[FACT].columns) == set(SUITES[FACT].columns())
    assert taken[FACT].count() == queries.QUERIES["fct_participant_match"](spark, SF_DIR).count()


def test_partitions_are_merged_to_little_memory_unless_the_session_says_otherwise(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        queries.QUERIES["limit_n"](spark, SF_DIR)
        assert spark.conf.get(name) == "16MB"
        spark.conf.set(name, "5MB")
        queries.QUERIES["limit_n"](spark, SF_DIR)
        assert spark.conf.get(name) == "5MB"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
