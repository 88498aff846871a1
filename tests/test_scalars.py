import datetime as dt

import pytest
from pyspark.sql import functions as F

from medalstar.functions import lookups, scalars
from medalstar.functions.assets import Assets


def evaluate(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_safe_ratio_falls_back_to_zero(spark):
    rows = [(3, 4), (3, 0), (3, None), (None, 4), (3, -1)]
    assert evaluate(spark, rows, "n bigint, d bigint", scalars.safe_ratio("n", "d")) == [0.75, 0.0, 0.0, None, 0.0]


def test_per_minute(spark):
    rows = [(600, 120), (600, 0), (600, None)]
    assert evaluate(spark, rows, "n bigint, d bigint", scalars.per_minute("n", "d")) == [300.0, 0.0, 0.0]


def test_kda_without_deaths_is_takedowns(spark):
    rows = [(4, 2, 2), (4, 0, 2), (4, None, 2)]
    assert evaluate(spark, rows, "k bigint, d bigint, a bigint", scalars.kda("k", "d", "a")) == [3.0, 6.0, None]


def test_blank_fallback_strips_every_whitespace(spark):
    rows = [("", "r"), ("  ", "r"), ("\t", "r"), ("\n \t", "r"), (None, "r"), ("\t Ann \n", "r"), ("", None)]
    column = scalars.blank_fallback("s", "f")
    assert evaluate(spark, rows, "s string, f string", column) == ["r", "r", "r", "r", "r", "Ann", None]


def test_version_parts(spark):
    rows = [("14.24.1",), ("14",), ("14.",), (None,)]
    assert evaluate(spark, rows, "v string", scalars.patch_major("v")) == ["14.24", None, "14.", None]
    assert evaluate(spark, rows, "v string", scalars.version_part("v", 1)) == ["14", "14", "14", None]


def test_iso_timestamp_is_utc_and_strict(spark):
    rows = [("2025-01-04T10:00:00.123456",)]
    frame = spark.createDataFrame(rows, "t string")
    shown = frame.select(F.unix_micros(scalars.iso_timestamp("t"))).first()[0]
    assert shown == 1735984800123456
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("yesterday",)], "t string").select(scalars.iso_timestamp("t")).collect()


def test_epoch_ms_is_exact_and_tenths_round(spark):
    late = 1735948799960  # 2025-01-03 23:59:59.960
    day = lambda tenths: F.to_date(scalars.epoch_ms("ms", tenths))
    assert evaluate(spark, [(late,)], "ms bigint", day(False)) == [dt.date(2025, 1, 3)]
    assert evaluate(spark, [(late,)], "ms bigint", day(True)) == [dt.date(2025, 1, 4)]


def test_code_lookup(spark):
    rows = [("TOP",), ("",), (None,)]
    icon = scalars.code_lookup("p", lookups.ROLE_ICONS, lookups.UNKNOWN_ROLE_ICON)
    assert evaluate(spark, rows, "p string", icon) == ["🛡️", "❓", "❓"]
    assert evaluate(spark, rows, "p string", scalars.code_lookup("p", lookups.ROLE_ICONS)) == ["🛡️", None, None]


def test_flag_has_no_null(spark):
    rows = [(420,), (450,), (None,)]
    column = scalars.flag(F.col("q").isin(lookups.RANKED_QUEUES))
    assert evaluate(spark, rows, "q bigint", column) == [True, False, False]


def test_addresses(spark):
    urls = Assets(cdn="http://cdn", version="9", emblem_base="http://emblems")
    rows = [(4, "Ahri", "GOLD"), (0, None, "WOOD"), (None, None, None)]
    schema = "id bigint, name string, tier string"
    one = lambda column: evaluate(spark, rows, schema, column)
    assert one(urls.item_slot(F.col("id"))) == ["http://cdn/9/img/item/4.png", None, None]
    assert one(urls.champion_icon(F.col("name"))) == ["http://cdn/9/img/champion/Ahri.png", None, None]
    assert one(urls.champion_splash(F.col("name"))) == ["http://cdn/img/champion/splash/Ahri_0.jpg", None, None]
    assert one(urls.known_spell(F.col("id"))) == ["http://cdn/9/img/spell/SummonerFlash.png", None, None]
    assert one(urls.keystone(F.lit(8465)))[0].endswith("perk-images/Styles/Resolve/Guardian/Guardian.png")
    assert one(urls.rank_emblem(F.col("tier"))) == ["http://emblems/emblem-gold.png", None, None]


def test_fixed_tables_have_their_sizes():
    sizes = [len(t) for t in (lookups.SPELLS, lookups.KEYSTONES, lookups.RUNE_TREES, lookups.ROLE_ICONS)]
    assert sizes == [11, 17, 5, 5]
    assert len(lookups.EMBLEM_TIERS) == 10
