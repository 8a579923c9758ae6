"""Changes committed after their window was read."""

from datetime import datetime, timedelta

import pytest

from tidemark.operators.ledger import Ledger
from tidemark.plans import job as jobs
from tidemark.session import workspace
from tidemark.sources import late, staged

SCHEMA = "k int, v string, at timestamp_ntz, other timestamp_ntz"


def _day(d, m=1):
    return datetime(2024, m, d)


def _setup(spark, **more):
    root = workspace(spark, "late")
    seen = [None]
    place = jobs.Place(spark, lambda job: spark.createDataFrame(seen[0], SCHEMA), f"{root}/stage", f"{root}/targets", Ledger(spark, f"{root}/ledger"))
    job = {"job_id": 1, "source_db": "s", "source_schema": "d", "source_table": "t", "target_db": "D", "target_schema": "S",
           "target_table": "T", "load_type": "incremental", "scd_type": 0, "primary_key": "k", "cdc_columns": "at",
           "lookback_seconds": 3 * 86400, **more}

    def run(batch, when, rows, mode="FULL"):
        seen[0] = rows
        return jobs.run_table(place, job, mode, batch, when)
    return place, job, run


def _held(place, job):
    return sorted((r["k"], r["v"]) for r in place.target(job).read().collect())


def test_a_late_row_is_moved_once(spark):
    place, job, run = _setup(spark)
    first = [(1, "a", _day(1), None), (2, "b", _day(9), None), (2, "b", _day(9), None), (8, None, _day(9), None)]
    assert run(1, _day(10), first)["status"] == "SUCCESS"
    # committed late: a row, a repeat of a moved one; beyond the lookback: one; changed without a new time: one
    after = [*first, (3, "late", _day(8), None), (2, "b", _day(9), None), (4, "too late", _day(2), None), (5, "now", _day(11), None)]
    after[3] = (8, "", _day(9), None)
    assert run(2, _day(12), after)["rows_extracted"] == 4
    want = sorted([(1, "a"), (2, "b"), (2, "b"), (2, "b"), (3, "late"), (5, "now")])
    assert [x for x in _held(place, job) if x[0] != 8] == want
    assert run(3, _day(13), after)["rows_extracted"] == 0


def test_an_export_that_died_leaves_its_rows_to_the_next(spark):
    place, job, run = _setup(spark)
    rows = [(1, "a", _day(9), None)]
    run(1, _day(10), rows)
    receipts = late.Receipts(spark, f"{place.targets}/_receipts/{staged.source_name(job)}")
    more = [*rows, (2, "b", _day(9), None)]
    receipts.add(spark.createDataFrame(more, SCHEMA), ["at"], 2)  # the receipt is there, the export is not
    assert run(3, _day(11), more)["rows_extracted"] == 1
    assert _held(place, job) == [(1, "a"), (2, "b")]


def test_windows_without_receipts_are_not_searched(spark):
    place, job, run = _setup(spark)
    job["lookback_seconds"] = 0
    rows = [(1, "a", _day(9), None)]
    run(1, _day(10), rows)
    job["lookback_seconds"] = 3 * 86400
    assert run(2, _day(11), [*rows, (2, "late", _day(9), None), (3, "c", _day(10), None)])["rows_extracted"] == 1
    assert run(3, _day(12), [*rows, (3, "c", _day(10), None), (4, "late", _day(10), None)])["rows_extracted"] == 1


def test_several_change_times(spark):
    place, job, run = _setup(spark, cdc_columns="at, other")
    rows = [(1, "a", _day(1), _day(11)), (2, "b", _day(9), _day(2)), (3, "c", None, _day(9))]
    assert run(1, _day(10), rows)["rows_extracted"] == 3
    assert run(2, _day(12), [*rows, (4, "late", None, _day(9))])["rows_extracted"] == 2  # 1 lies in this window too
    assert run(3, _day(13), [*rows, (4, "late", None, _day(9))])["rows_extracted"] == 0


@pytest.mark.parametrize("there,moved,left", [(3, 1, 2), (1, 3, 0), (2, 2, 0), (2, 0, 2)])
def test_equal_rows_are_counted(spark, there, moved, left):
    row = (1, None, _day(9), None)
    rows, before = (spark.createDataFrame([row] * n, SCHEMA) for n in (there, moved))
    got = late.not_moved(rows, late.digests(before, ["at"]))
    assert got.schema == rows.schema and got.count() == left
    zone = late.with_late(rows, ["at"], _day(10), _day(12), _day(10) - timedelta(days=2), late.digests(before, ["at"]))
    assert zone.count() == left
