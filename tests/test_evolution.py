"""Changed columns, streams of finished batches, minimal keys, splits."""

from datetime import datetime
from itertools import combinations

import pytest
from pyspark.sql import types as T

from checks.common import TABLES
from tidemark.functions.types import evolved, widened
from tidemark.operators.ledger import Ledger
from tidemark.plans import job as jobs, reconcile
from tidemark.session import workspace
from tidemark.sources import discover, staged, tables
from tidemark.streaming.staged_stream import ready_batches


def schema(*fields):
    return T.StructType([T.StructField(n, t, null) for n, t, null in fields])


def test_types_only_grow():
    assert widened(T.IntegerType(), T.LongType()) == widened(T.LongType(), T.ShortType()) == T.LongType()
    assert widened(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert widened(T.DecimalType(10, 2), T.DecimalType(12, 2)) == T.DecimalType(12, 2)
    assert widened(T.DecimalType(10, 2), T.DecimalType(10, 4)) is None
    assert widened(T.LongType(), T.StringType()) is None and widened(T.DateType(), T.TimestampNTZType()) is None
    old = schema(("k", T.IntegerType(), False), ("a", T.StringType(), True))
    new = evolved(old, schema(("B", T.DoubleType(), False), ("A", T.StringType(), True), ("K", T.LongType(), False)), ["k"])
    assert [(f.name, f.dataType, f.nullable) for f in new] == [
        ("k", T.LongType(), False), ("a", T.StringType(), True), ("B", T.DoubleType(), True)]
    assert evolved(old, schema(("k", T.IntegerType(), False)), ["k"]).names == ["k", "a"]
    with pytest.raises(ValueError):
        evolved(old, schema(("a", T.StringType(), True)), ["k"])


def test_a_type_that_does_not_fit_is_refused_before_the_watermark_moves(spark):
    root = workspace(spark, "run")
    sources = [spark.createDataFrame([(1, 5, "2024-01-01")], "k int, n long, at string"),
               spark.createDataFrame([(1, "five", "2024-01-02")], "k int, n string, at string"),
               spark.createDataFrame([(1, 7, "2024-01-02"), (2, 1 << 40, "2024-01-03")], "k long, n long, at string")]
    sources = [s.selectExpr(*[c for c in s.columns if c != "at"], "cast(at as timestamp_ntz) as at") for s in sources]
    place = jobs.Place(spark, lambda job: sources[0], f"{root}/stage", f"{root}/targets", Ledger(spark, f"{root}/ledger"))
    job = {"source_db": "s", "source_schema": "d", "source_table": "t", "target_db": "A", "target_schema": "P", "target_table": "T",
           "load_type": "incremental", "scd_type": 1, "primary_key": "k", "cdc_type": "TIMESTAMP", "cdc_columns": "at"}
    assert jobs.run_table(place, job, "FULL", 1, datetime(2024, 1, 1, 12))["status"] == "SUCCESS"
    mark = place.ledger.watermark(job)["window_end"]
    sources.pop(0)
    failed = jobs.run_table(place, job, "FULL", 2, datetime(2024, 1, 4))
    assert failed["status"] == "FAILED" and "does not fit" in failed["log"]
    assert place.ledger.watermark(job)["window_end"] == mark and staged.pending_batches(spark, place.stage, job) == [1]
    sources.pop(0)
    assert jobs.run_table(place, job, "FULL", 3, datetime(2024, 1, 5))["status"] == "SUCCESS"  # a wider key, read from old files too
    assert sorted((r.k, r.n) for r in place.target(job).read().collect()) == [(1, 7), (2, 1 << 40)]


def test_batches_wait_for_the_missing_one_until_it_is_given_up():
    assert ready_batches([1, 3], [], 5) == [1]
    assert ready_batches([1, 2, 3], [[1, 1]], 5) == [2, 3]
    assert ready_batches([3, 4, 5], [[1, 1]], 2) == [3, 4, 5]  # three newer batches are there: 2 is given up
    assert ready_batches([3, 4], [[1, 1]], 2) == []
    assert ready_batches([5, 3], [[1, 1]], None) == [3, 5] and ready_batches([], [], 1) == []


def test_minimal_keys_against_all_combinations(spark, sf):
    for name in TABLES:
        df = spark.read.parquet(f"{sf}/{name}.parquet")
        columns = [f.name for f in df.schema if discover._comparable(f)]
        rows = df.select(*columns).collect()
        want: list[tuple] = []
        for width in (1, 2, 3):
            for c in combinations(columns, width):
                if not any(set(k) <= set(c) for k in want):
                    values = [tuple(r[x] for x in c) for r in rows]
                    if len(set(values)) == len(values) and not any(None in v for v in values):
                        want.append(c)
        assert discover.minimal_keys(df, 3) == want or sorted(discover.minimal_keys(df, 3)) == sorted(want), name


def test_minimal_keys_count_shared_parts_once(spark, monkeypatch):
    monkeypatch.setattr(discover, "PARTS_FROM", 10)
    # (a, b) tells nearly all rows apart; with c or d it is a key, with e it is not
    rows = [(i // 20, i % 20, 0, i % 3, "x") for i in range(400)] + [(0, 0, 1, 1, "x"), (1, 1, 2, 2, "x"), (2, 2, 3, 1, "x")]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e string").repartition(3)
    over, whole = [], discover._no_repeat
    monkeypatch.setattr(discover, "_no_repeat", lambda rows, c: over.append((c, rows.count())) or whole(rows, c))
    assert discover.minimal_keys(df, 3) == [("a", "b", "c"), ("a", "b", "d")]
    # each is counted over the six rows that (a, b) leaves together, after a part of all values
    assert [n for c, n in over if c == ("a", "b", "c")][-1] == [n for c, n in over if c == ("a", "b", "d")][-1] == 6


def test_reconciled_rows_with_nulls_and_repeats(spark):
    old = [(1, "a"), (1, "a"), (2, None), (None, "n"), (3, ""), (4, "x"), (5, "y"), (5, "z")]
    new = [(1, "a"), (2, ""), (None, "n"), (3, ""), (5, "z"), (5, "y"), (6, None)]
    a, b = (spark.createDataFrame(rows, "k int, v string") for rows in (old, new))
    got = {(r.k, r.difference) for r in reconcile.reconcile_rows(a, b, ["k"], buckets=4).collect()}
    assert got == {(1, "changed"), (2, "changed"), (4, "lost"), (6, "added")}
    assert reconcile.reconcile_rows(a, a.repartition(3), ["k"]).count() == 0
    plan = reconcile.reconcile_rows(a, b, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_splits_of_ties_and_nulls(spark):
    rows = spark.createDataFrame([(None,)] * 3 + [(7,)] * 50 + [(i,) for i in range(50)], "v int")
    bounds = tables.split_bounds(rows, "v", 8)
    counts = [rows.where(c).count() for c in tables.split_conditions("v", bounds)]
    assert sum(counts) == 103 and len(set(bounds)) == len(bounds)
    assert tables.split_conditions("v", tables.split_bounds(rows.limit(0), "v", 8)) == ["1 = 1"]


def test_export_of_a_stream_runs_its_query_once(spark, tmp_path, monkeypatch):
    """The cut into files is measured on the rows the de-duplication reads, not by a second run of it."""
    from checks import evolution

    (spark.range(50).selectExpr("id % 20 AS l_orderkey", "1L AS l_linenumber", "'R' AS l_returnflag", "'F' AS l_linestatus",
                                "timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, cast(id as int)) AS l_shipdate")
     .write.parquet(f"{tmp_path}/lineitem.parquet"))
    plans, real = [], staged.rows_for
    monkeypatch.setattr(staged, "rows_for", lambda rows, *a: plans.append(rows._jdf.queryExecution().analyzed().toString()) or real(rows, *a))
    place, settings, export, _ = evolution._staged_lines(spark, str(tmp_path), 2)
    export(1)
    folder = staged.batch_folder(place.stage, settings, 1)
    assert spark.read.csv(folder, sep="|").count() == 20
    assert len(plans) == 1 and "row_number" not in plans[0]
