"""Landed JSON files to stored bronze tables, with rejected documents kept aside."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medalstar import schemas
from medalstar.operators.joins import broadcast_if_small
from medalstar.operators.shape import union_all
from medalstar.plans import bronze
from medalstar.sources import documents
from medalstar.sources.tables import replace_files
from medalstar.sources.versions import read_current


def _store(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    return replace_files(df, path)


def ingest_matches(
    spark: SparkSession, path: str, root: str, ingest_ts: str, one_per_file: bool = False
) -> dict[str, DataFrame]:
    """Participants, teams and the rejected documents of a folder of match JSON.

    The JSON is parsed once into a nested Parquet table, which both bronze tables then read by
    column. A rejected document keeps its text and its reason.
    """
    landed = documents.read_text_documents(spark, path, one_per_file).withColumn(
        "file_path", F.col("_metadata.file_path")
    )
    judged = documents.match_rejection(documents.parse_documents(landed, "value", schemas.MATCH_DOCUMENT))
    rejected = F.col("reason").isNotNull()
    staged = _store(spark, judged.select(
        "file_path", F.when(rejected, F.col("value")).alias("value"), "metadata", "info", "reason"
    ), f"{root}/staging/matches")
    accepted, repeated = _first_of_each_match(staged.filter(~rejected), root)
    return {
        "matches_participants": _store(
            spark, bronze.flatten_participants(accepted, ingest_ts), f"{root}/bronze/matches_participants"
        ),
        "matches_teams": _store(spark, bronze.flatten_teams(accepted, ingest_ts), f"{root}/bronze/matches_teams"),
        "rejected_matches": staged.filter(rejected).select("file_path", "reason", "value").unionByName(
            repeated.select("file_path", F.lit("repeated").alias("reason"), F.lit(None).cast("string").alias("value"))),
    }


def _first_of_each_match(staged: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(documents to flatten, places of documents that repeat a match); the first by file stays.

    Only the places of repeated documents are joined back, so the wide documents are not shuffled.
    """
    place = F.struct(
        "file_path", F.col("_metadata.file_path").alias("part"), F.col("_metadata.row_index").alias("row")).alias("place")
    rows = staged.select(F.col("metadata.matchId").alias("match_id"), place)
    first = rows.groupBy("match_id").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    repeated = rows.join(first, "match_id").filter(F.col("place") != F.col("first")).select("place.*")
    repeated = replace_files(repeated, f"{root}/staging/repeated_matches")
    located = staged.select(
        "metadata", "info", F.col("_metadata.file_path").alias("part"), F.col("_metadata.row_index").alias("row"))
    return located.join(broadcast_if_small(repeated.select("part", "row")), ["part", "row"], "left_anti").select(
        "metadata", "info"), repeated


def ingest_ladder(
    spark: SparkSession, tier_paths: Mapping[str, str], root: str, platform: str, ingest_ts: str, k: int | None
) -> DataFrame:
    """The ladder from one folder of ladder JSON per tier, the tiers in the order of the mapping, highest first.

    ``k`` players are kept, all of them if None. ``rejected_ladder`` tells what could not be used.
    """
    landed = union_all([
        documents.read_text_documents(spark, path, one_per_file=True).select(
            "value", F.lit(tier).alias("tier"), F.col("_metadata.file_path").alias("file_path"))
        for tier, path in tier_paths.items()
    ])
    parsed = _store(spark, documents.parse_documents(landed, "value", schemas.LADDER_DOCUMENT), f"{root}/staging/ladder")
    _store(spark, bronze.rejected_entries(parsed, ["file_path", "tier"]), f"{root}/staging/rejected_ladder")
    readable = parsed.filter(F.col("entries").isNotNull())
    rows = bronze.flatten_ladder(readable, platform, ingest_ts, k, list(tier_paths))
    return _store(spark, rows, f"{root}/bronze/ladder")


def ingest_match_ids(
    spark: SparkSession, path: str, root: str, platform: str, region: str, queue_id: int, ingest_ts: str,
    per_player: int | None,
) -> DataFrame:
    """The matches to fetch, from a folder of players' match lists: a JSON line ``{"puuid", "ids"}`` per player.

    A match on several lists stays with the first of them, in the order of files and of lines in a file. Lines without player
    or list are kept aside with their reason, see ``rejected_lists``.
    """
    landed = documents.read_text_documents(spark, path).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"))
    parsed = _store(spark, documents.parse_documents(landed, "value", schemas.MATCH_LIST), f"{root}/staging/match_lists")
    usable = F.col("puuid").isNotNull() & F.col("ids").isNotNull()
    _store(spark, parsed.filter(~usable).select(
        "file_path", F.when(F.col("_corrupt").isNotNull(), "unreadable").otherwise("player or list missing").alias("reason"),
        "value"), f"{root}/staging/rejected_lists")
    lists = parsed.filter(usable).withColumn("arrival", F.struct("file_path", "block", "line"))
    return _store(spark, bronze.match_ids(lists, "arrival", platform, region, queue_id, ingest_ts, per_player),
                  f"{root}/bronze/match_ids")


def rejected_lists(spark: SparkSession, root: str) -> DataFrame:
    """(file_path, reason, value) of the lines the last ``ingest_match_ids`` left out."""
    return read_current(spark, f"{root}/staging/rejected_lists", StructType.fromDDL(
        "file_path string, reason string, value string"))


def rejected_ladder(spark: SparkSession, root: str) -> DataFrame:
    """(file_path, tier, reason, value) of the documents and entries the last ``ingest_ladder`` left out."""
    return read_current(spark, f"{root}/staging/rejected_ladder", StructType.fromDDL(
        "file_path string, tier string, reason string, value string"))
