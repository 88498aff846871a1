from medalstar import schemas
from medalstar.plans.gold import FACT_COLUMNS
from medalstar.plans.silver import PARTICIPANT_COLUMNS
from medalstar.plans.suites import SUITES


def test_column_counts():
    assert {name: len(s.fields) for name, s in schemas.BRONZE.items()} == {
        "ladder": 8, "match_ids": 6, "matches_participants": 75, "matches_teams": 24,
    }
    assert len(PARTICIPANT_COLUMNS) == len(set(PARTICIPANT_COLUMNS)) == 79
    assert len(FACT_COLUMNS) == len(set(FACT_COLUMNS)) == 69


def test_snake_case_rule():
    assert schemas.snake("totalTimeCCDealt") == "total_time_cc_dealt"
    assert schemas.snake("summoner1Id") == "summoner1_id"
    assert schemas.snake("riftHerald") == "rift_herald"
    assert schemas.snake("item0") == "item0"
    assert schemas.snake("detectorWardsPlaced") == "control_wards_placed"


def test_number_of_declared_checks():
    assert sum(s.count() for s in SUITES.values()) == 47
    assert sum(len(s.not_null) for s in SUITES.values()) == 34
    assert sum(len(s.unique) for s in SUITES.values()) == 8
