"""Load operators against a plain row-by-row model on random small tables."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tidemark.functions.types import with_history
from tidemark.operators import merge
from tidemark.operators.dedup import dedup
from tidemark.operators.target import Target
from tidemark.session import workspace

T0, T1 = datetime(2024, 1, 1), datetime(2024, 2, 1)
KEY = st.one_of(st.none(), st.integers(1, 4))
TEXT = st.sampled_from([None, "", "a", "b"])
SCHEMA = "k int, v string, n int"
few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
rows = st.lists(st.tuples(KEY, TEXT, st.one_of(st.none(), st.integers(0, 1))), max_size=6)
unique = st.lists(st.tuples(KEY, TEXT, st.one_of(st.none(), st.integers(0, 1))), max_size=5,
                  unique_by=lambda r: r[0] if r[0] is not None else object())


def as_text(v):
    return "" if v is None else str(v)


def model_scd2(target, source):
    """target rows (k, v, n, current, start, end); source rows (k, v, n)."""
    out, kept = [], set()
    by_key = {r[0]: r for r in source if r[0] is not None}
    for k, v, n, current, start, end in target:
        hit = by_key.get(k) if current else None
        if hit and (as_text(v), as_text(n)) != (as_text(hit[1]), as_text(hit[2])):
            out.append((k, v, n, False, start, T1))
        else:
            out.append((k, v, n, current, start, end))
            if hit:
                kept.add(k)
    return out + [(*r, True, T1, None) for r in source if r[0] is None or r[0] not in kept]


def model_scd1(target, source):
    by_key = {r[0]: r for r in source if r[0] is not None}
    known = {r[0] for r in target if r[0] is not None}
    return ([by_key.get(r[0], r) if r[0] is not None else r for r in target]
            + [r for r in source if r[0] is None or r[0] not in known])


def same(df, wanted):
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(wanted, key=key)


@few
@given(target=rows, source=unique, small=st.booleans())
def test_scd1(spark, target, source, small):
    t, s = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    same(merge.scd1(t, s, ["k"], small_work=small), model_scd1(target, source))


@few
@given(target=rows, closed=rows, source=unique, small=st.booleans())
def test_scd2(spark, target, closed, source, small):
    old = [(*r, True, T0, None) for r in target] + [(*r, False, T0, T0) for r in closed]
    schema = with_history(spark.createDataFrame([], SCHEMA), T0).schema
    t, s = spark.createDataFrame(old, schema), spark.createDataFrame(source, SCHEMA)
    same(merge.scd2(t, s, ["K"], T1, small_work=small), model_scd2(old, source))


@settings(few, max_examples=4)
@given(target=rows, closed=rows, source=unique)
def test_scd2_target(spark, target, closed, source):
    old = [(*r, True, T0, None) for r in target] + [(*r, False, T0, T0) for r in closed]
    schema = with_history(spark.createDataFrame([], SCHEMA), T0).schema
    table = Target(spark, workspace(spark, "t")).create(schema, ["k"], 3)
    table.seed(spark.createDataFrame(old, schema))
    wanted = model_scd2(old, source)
    counts = table.track(spark.createDataFrame(source, SCHEMA), T1)
    same(table.read(), wanted)
    assert counts.rows_inserted == sum(r[3] is True and r[4] == T1 for r in wanted)
    assert counts.rows_expired == sum(r[5] == T1 for r in wanted)


@settings(few, max_examples=4)
@given(target=rows, source=unique)
def test_scd1_target(spark, target, source):
    table = Target(spark, workspace(spark, "t")).create(spark.createDataFrame([], SCHEMA).schema, ["k"], 3)
    table.seed(spark.createDataFrame(target, SCHEMA))
    counts = table.upsert(spark.createDataFrame(source, SCHEMA))
    same(table.read(), model_scd1(target, source))
    known = {r[0] for r in target} - {None}
    assert counts.rows_inserted == sum(r[0] not in known for r in source)


def test_history_needs_values_to_compare(spark):
    """A history table of keys alone never expires a row."""
    t = with_history(spark.range(3).select("id"), T0)
    out = merge.scd2(t, spark.range(5), ["id"], T1)
    assert out.where("not is_current").count() == 0 and out.count() == 5


def test_loads_that_lose_history_are_refused(spark):
    history, plain = with_history(spark.range(3), T0), spark.range(2)
    for load in (lambda: merge.append(history, plain), lambda: merge.full_replace(history, plain),
                 lambda: merge.filter_reload(history, plain, "id = 1"), lambda: merge.scd1(history, plain, ["id"])):
        with pytest.raises(merge.HistoryLossError):
            load()
    assert merge.append(history, plain, allow_history_loss=True).count() == 5


def test_missing_keys_are_an_error(spark):
    with pytest.raises(ValueError):
        merge.scd1(spark.range(1), spark.range(1), [])
    with pytest.raises(ValueError):
        merge.scd2(with_history(spark.range(1), T0), spark.range(1), ["nope"], T1)


def test_dedup_cuts_each_partition_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    out = dedup(df, ["k"], ["v"])
    assert sorted((r["k"], r["v"]) for r in out.collect()) == [(0, 999), (1, 997), (2, 998)]
    assert "Partial" in out._jdf.queryExecution().executedPlan().toString()


def test_small_work_does_not_shuffle_the_target(spark, sf):
    target = spark.read.parquet(f"{sf}/lineitem.parquet")
    work = dedup(target, ["l_orderkey"], ["l_shipdate"])
    out = merge.upserted(target, work, ["l_orderkey"], small_work=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
