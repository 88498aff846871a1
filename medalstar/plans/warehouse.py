"""Stored silver and gold tables: each is computed once from its inputs and read back from Parquet."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from medalstar.operators import quality
from medalstar.operators.keys import grow_registry, registered_key
from medalstar.plans import gold, partials, silver
from medalstar.plans.suites import SUITES
from medalstar.session import new_shared_folder, scratch
from medalstar.sources.tables import replace_files, write_months
from medalstar.sources.versions import current_version, has_version, read_current

FACT = "fct_participant_match"
NUMBERED = {"dim_player", "dim_queue_patch"}  # dimensions with surrogate keys

# table -> (inputs in argument order, function)
MODELS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "stg_ladder": (("ladder",), silver.stg_ladder),
    "stg_matches_participants": (("matches_participants",), silver.stg_matches_participants),
    "stg_matches_teams": (("matches_teams",), silver.stg_matches_teams),
    "dim_champion": (("stg_matches_participants",), gold.dim_champion),
    "dim_date": (("stg_matches_participants",), gold.dim_date),
    "dim_item": (("stg_matches_participants",), gold.dim_item),
    "dim_spell": (("stg_matches_participants",), gold.dim_spell),
    "dim_queue_patch": (("stg_matches_participants",), gold.dim_queue_patch),
    "dim_player": (("stg_matches_participants", "stg_ladder"), gold.dim_player),
    FACT: (
        ("stg_matches_participants", "stg_matches_teams", "stg_ladder", "dim_player", "dim_queue_patch"),
        gold.fct_participant_match_by_month,
    ),
}


class Warehouse:
    """Silver and gold over given bronze tables, below one folder.

    Silver is stored because seven gold tables read it; a table is written on first use.
    """

    def __init__(
        self, spark: SparkSession, bronze: Mapping[str, DataFrame], root: str,
        dedupe_keys: Mapping[str, Sequence[str]] | None = None, keep_keys: bool = False,
        columns: Mapping[str, Sequence[str]] | None = None, in_plan: Collection[str] = (),
    ):
        """``dedupe_keys``: the grain to keep the newest row of, for silver tables with repeated ingests.

        ``keep_keys``: members of an earlier build below ``root`` keep their surrogate keys, so that facts stored with
        them stay right; otherwise every build numbers its members anew.

        For a store that serves few questions: ``columns`` names the columns that are kept of a table, so that no other
        is computed, shuffled or written on its way there, nor a table built that gives none of them; tables of ``in_plan`` are not stored but computed by whoever
        reads them, in the columns that it reads. All rows are there in either case.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self._bronze = bronze
        self._dedupe = dict(dedupe_keys or {})
        self._keep_keys = keep_keys
        self._columns = dict(columns or {})
        self._in_plan = frozenset(in_plan)
        self._stored: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        """The folder of a table's versions."""
        layer = "silver" if name.startswith("stg_") else "gold"
        return f"{self.root}/{layer}/{name}"

    def table(self, name: str) -> DataFrame:
        if name in self._bronze:
            return self._bronze[name]
        if name not in self._stored:
            inputs, model = MODELS[name]
            kept = self._columns.get(name)
            if name == "dim_player" and kept and set(kept) <= set(gold.PLAYER_KEY):
                inputs, model = ("stg_matches_participants",), gold.player_keys
            unread = gold.unread(kept) if name == FACT and kept else []
            options = {"dedupe_keys": self._dedupe[name]} if name in self._dedupe else {}
            if self._keep_keys and name in NUMBERED:
                options["number"] = self._number
            read = [None if i in unread else self.table(i) for i in inputs]
            with scratch(self.spark):
                df = model(*read, **options)
                if kept:
                    df = df.select(*kept)
                if name in self._in_plan:
                    return df
                self._stored[name] = replace_files(df, self.path(name), *([write_months] if name == FACT else []))
        return self._stored[name]

    def _number(self, df: DataFrame, name: str, order_by: Sequence[str]) -> DataFrame:
        """Keys from the registry stored below ``root``, which first grows by the members it lacks."""
        folder, stored = f"{self.root}/keys/{name}", new_shared_folder(self.spark, "members")
        df.write.parquet(stored)
        members = self.spark.read.schema(df.schema).parquet(stored)
        schema = StructType([StructField(name, LongType()), *[df.schema[c] for c in order_by]])
        known = has_version(self.spark, folder)
        registry = read_current(self.spark, folder, schema) if known else self.spark.createDataFrame([], schema)
        grown = replace_files(grow_registry(registry, members, name, order_by), folder)
        return registered_key(members, grown, name, order_by)

    def build(self, names: Collection[str] = tuple(MODELS)) -> dict[str, DataFrame]:
        """These tables, all ten unless given, layer by layer; the tables of a layer are independent jobs run side by side."""
        with ThreadPoolExecutor(max_workers=6) as pool:
            for prefix in ("stg_", "dim_", "fct_"):
                # The threads keep the caller's job group and local properties.
                build = inheritable_thread_target(self.spark)(self.table)
                list(pool.map(build, [name for name in MODELS if name in names and name.startswith(prefix)]))
        return {name: self.table(name) for name in MODELS if name in names}

    def publish(self, silver_db: str = "silver", gold_db: str = "gold") -> None:
        """Make the stored tables available to SQL as ``silver.<table>`` and ``gold.<table>``."""
        for database in (silver_db, gold_db):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name in self.build():
            table = f"{silver_db if name.startswith('stg_') else gold_db}.{name}"
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{current_version(self.spark, self.path(name))}'")
            if name == FACT:
                self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")

    def refresh_marts(self, months: Sequence[str | None] | None = None) -> None:
        """Store the monthly partials of the business questions, of these months of the fact only if they are given."""
        partials.refresh(self.table(FACT), f"{self.root}/gold", months)

    def mart(self, name: str) -> DataFrame:
        """A business question from its stored partials."""
        return partials.combine(name, partials.stored(self.spark, f"{self.root}/gold", name), self.table("dim_queue_patch"))

    def check(self) -> DataFrame:
        """The report of all declared checks."""
        return quality.report(self.build(), SUITES)
