"""Month snapshots: revisions, replays, crashes, how much a touch reads."""

import pytest

from cubewise.operators.pivot import pivot_measures
from cubewise.plans.staging import stage_centre_stats
from cubewise.schemas import LANDING_CENTRE_SCHEMA
from cubewise.session import scratch_path
from cubewise.streaming import incremental
from cubewise.streaming.incremental import refresh_touched
from cubewise.streaming.months import NO_MONTH, MonthStore

SERIES = ["statistic", "year", "month", "test_category", "test_centre_raw"]


def extract(spark, *rows):
    return spark.createDataFrame([("apps", m, c, "A, Co. X", "Number", v) for m, c, v in rows], LANDING_CENTRE_SCHEMA)


def fact(staged):
    return pivot_measures(staged, ["year", "month", "test_category"], "statistic", "unit", {"apps": "n"}, "sum")


@pytest.fixture
def places(spark):
    return {"state_dir": scratch_path(spark, "m state"), "fact_dir": scratch_path(spark, "m fact"), "build_fact": fact,
            "keys": SERIES, "fact_snapshots": True}


def rows(spark, places):
    schema = "year string, month string, test_category string, n bigint"
    got = MonthStore(spark, places["fact_dir"]).read(spark.createDataFrame([], schema).schema)
    return sorted(((r["month"], r["test_category"], r["n"]) for r in got.collect()), key=str)


def test_the_latest_epoch_of_a_key_counts(spark, places):
    refresh_touched(spark, extract(spark, ("2021 January", "B", 10), ("2021 January", None, 3), ("2021 March", "B", 1)), 0, **places)
    assert refresh_touched(spark, extract(spark, ("2021 January", "B", 4)), 1, **places) == ["2021-01-01"]
    refresh_touched(spark, extract(spark, ("2021 January", None, 2), ("oops", "B", 9)), 2, **places)
    assert sorted(rows(spark, places), key=str) == sorted(
        [("January", "B", 4), ("January", None, 2), ("March", "B", 1), (None, "B", 9)], key=str)
    assert NO_MONTH in MonthStore(spark, places["state_dir"]).months


def test_without_keys_all_rows_stay(spark, places):
    for epoch, value in enumerate((10, 4)):
        refresh_touched(spark, extract(spark, ("2021 January", "B", value)), epoch, **places | {"keys": None})
    assert rows(spark, places) == [("January", "B", 14)]


def test_a_replayed_epoch_changes_nothing(spark, places):
    for epoch, value in ((0, 10), (1, 4), (1, 4)):
        refresh_touched(spark, extract(spark, ("2021 January", "B", value), ("2021 May", "B", epoch)), epoch, **places | {"keys": None})
    assert rows(spark, places) == [("January", "B", 14), ("May", "B", 1)]
    with pytest.raises(ValueError, match="not its next"):
        refresh_touched(spark, extract(spark, ("2021 January", "B", 1)), 0, **places)


def test_a_crash_before_the_swap_is_harmless(spark, places, monkeypatch):
    refresh_touched(spark, extract(spark, ("2021 January", "B", 10)), 0, **places)

    def dies(*_, **__):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(MonthStore, "commit", dies)
    with pytest.raises(RuntimeError):
        refresh_touched(spark, extract(spark, ("2021 January", "B", 4)), 1, **places)
    monkeypatch.undo()
    assert rows(spark, places) == [("January", "B", 10)]
    refresh_touched(spark, extract(spark, ("2021 January", "B", 4)), 1, **places)
    assert rows(spark, places) == [("January", "B", 4)]


def test_a_crash_between_state_and_fact_is_mended_by_the_replay(spark, places, monkeypatch):
    refresh_touched(spark, extract(spark, ("2021 January", "B", 10)), 0, **places)

    def dies(_):
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError):
        refresh_touched(spark, extract(spark, ("2021 January", "B", 4)), 1, **places | {"build_fact": dies})
    assert rows(spark, places) == [("January", "B", 10)]
    refresh_touched(spark, extract(spark, ("2021 January", "B", 4)), 1, **places)
    assert rows(spark, places) == [("January", "B", 4)]


def test_a_touch_reads_a_month_once_however_often_it_was_touched(spark, places):
    for epoch in range(6):
        refresh_touched(spark, extract(spark, ("2021 January", "B", epoch), ("2021 May", "B", 1)), epoch, **places)
    state = MonthStore(spark, places["state_dir"])
    staged = stage_centre_stats(spark.createDataFrame([], LANDING_CENTRE_SCHEMA).toDF(
        "statistic", "month", "driving_test_categories", "driving_test_centre", "unit", "value"))
    held = state.read(staged.schema, ["2021-01-01"])
    assert held.count() == 1 and len(held.inputFiles()) == 1
    assert state.compact() and MonthStore(spark, places["state_dir"]).read(staged.schema).count() == 2
    assert rows(spark, places) == [("January", "B", 5), ("May", "B", 1)]


def test_a_month_without_fact_rows_disappears(spark, places):
    places["build_fact"] = lambda staged: fact(staged.where("unit > 0"))
    refresh_touched(spark, extract(spark, ("2021 January", "B", 10)), 0, **places)
    refresh_touched(spark, extract(spark, ("2021 January", "B", 0)), 1, **places)
    assert rows(spark, places) == []


def test_two_states_do_not_mix(spark, places):
    refresh_touched(spark, extract(spark, ("2021 January", "B", 1)), 0, **places)
    assert MonthStore(spark, places["state_dir"] + "_other").months == {}
    assert incremental.has_entries(spark, places["state_dir"]) and not incremental.has_entries(spark, places["state_dir"] + "_other")
