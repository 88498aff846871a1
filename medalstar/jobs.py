"""Command line for spark-submit: ``ingest`` lands JSON as bronze, ``build`` makes silver and gold.

    spark-submit medalstar/jobs.py ingest --matches IN --ladder MASTER=IN --platform vn2 --stamp TS --root OUT
    spark-submit medalstar/jobs.py build --root OUT [--load DATABASE]

``ingest --match-lists`` also lands the matches to fetch, ``build --load`` first loads bronze into a database.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from medalstar import schemas
from medalstar.plans.ingest import ingest_ladder, ingest_match_ids, ingest_matches, rejected_ladder, rejected_lists
from medalstar.plans.warehouse import Warehouse
from medalstar.session import LAUNCH_SETTINGS, configure, size_for
from medalstar.sources.tables import load_tables
from medalstar.sources.versions import current_version, has_version, read_current

BUILT_FROM = ["ladder", "matches_participants", "matches_teams"]


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    ingest = commands.add_parser("ingest")
    ingest.add_argument("--matches", required=True, help="folder of match JSON")
    ingest.add_argument("--ladder", action="append", required=True, metavar="TIER=FOLDER")
    ingest.add_argument("--platform", required=True)
    ingest.add_argument("--stamp", required=True, help="ingest time, ISO-8601")
    ingest.add_argument("--top", required=True, type=lambda n: None if n == "all" else int(n), help="ladder size, or all")
    ingest.add_argument("--one-per-file", action="store_true", help="one match document per file")
    ingest.add_argument("--match-lists", help="folder of players' match lists, a JSON line each")
    ingest.add_argument("--region", default="", help="region of the match lists")
    ingest.add_argument("--queue", type=int, default=420, help="queue of the match lists")
    ingest.add_argument("--per-player", type=int, help="ids of a list that count; all by default")
    build = commands.add_parser("build")
    build.add_argument("--load", metavar="DATABASE", help="load bronze into this database, and build from its tables")
    build.add_argument("--dedupe", action="store_true", help="keep the newest row of repeated ingests")
    build.add_argument("--keep-keys", action="store_true", help="members of earlier builds keep their surrogate keys")
    for command in (ingest, build):
        command.add_argument("--root", required=True, help="shared output folder")
        command.add_argument("--shuffled-gb", type=int, default=0, help="expected size of the largest shuffle")
    return parser.parse_args(argv)


def run(spark: SparkSession, argv: list[str]) -> int:
    """Run one command; the exit code of ``build`` tells whether every check passed (1) and every bronze table could be
    loaded (3), of ``ingest`` (2) whether something was rejected."""
    args = arguments(argv)
    size_for(configure(spark), args.shuffled_gb * 1024**3)
    if args.command == "ingest":
        matches = ingest_matches(spark, args.matches, args.root, args.stamp, args.one_per_file)
        tiers = dict(pair.split("=", 1) for pair in args.ladder)
        ingest_ladder(spark, tiers, args.root, args.platform, args.stamp, args.top)
        rejected, aside = 0, [("matches", matches["rejected_matches"]), ("ladder", rejected_ladder(spark, args.root))]
        if args.match_lists:
            ingest_match_ids(spark, args.match_lists, args.root, args.platform, args.region, args.queue, args.stamp, args.per_player)
            aside.append(("match lists", rejected_lists(spark, args.root)))
        for name, df in aside:
            for row in df.groupBy("reason").count().orderBy("reason").collect():
                print(f"rejected from {name}: {row['count']} {row['reason']}")
                rejected += row["count"]
        return 2 if rejected else 0
    if args.load:
        names = [n for n in schemas.BRONZE if n in BUILT_FROM or has_version(spark, f"{args.root}/bronze/{n}")]
        status = load_tables(spark, {n: _stored(spark, f"{args.root}/bronze/{n}") for n in names}, schemas.BRONZE, args.load)
        failed = status.filter(F.col("error").isNotNull())
        for row in status.orderBy("table_name").collect():
            print(f"loaded {row['table_name']}: {row['error'] or row['row_count']}")
        if failed.count():
            return 3
    bronze = {n: spark.table(f"{args.load}.{n}") for n in BUILT_FROM} if args.load else {
        n: read_current(spark, f"{args.root}/bronze/{n}", schemas.BRONZE[n]) for n in BUILT_FROM}
    grain = {"stg_matches_participants": ["match_id", "participant_id"], "stg_matches_teams": ["match_id", "team_id"]}
    store = Warehouse(spark, bronze, args.root, grain if args.dedupe else None, args.keep_keys)
    report = store.check().orderBy("passed", "table_name", "column_name")
    report.write.mode("overwrite").parquet(f"{args.root}/checks")
    failed = spark.read.parquet(f"{args.root}/checks").filter(~F.col("passed"))
    failed.show(100, truncate=False)
    return 1 if failed.count() else 0


def _stored(spark: SparkSession, folder: str) -> str:
    """The current version, or the folder itself, which the load then reports as unreadable."""
    return current_version(spark, folder) if has_version(spark, folder) else folder


def session() -> SparkSession:
    builder = SparkSession.builder.appName("medalstar")
    for key, value in LAUNCH_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


if __name__ == "__main__":
    sys.exit(run(session(), sys.argv[1:]))
