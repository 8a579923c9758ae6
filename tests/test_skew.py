"""A third of all rows under one key: results stay whole and no stage gathers them raw."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.types import with_history
from tidemark.operators import merge
from tidemark.operators.dedup import dedup
from tidemark.operators.ledger import fold
from tidemark.plans.replay import replay_scd2

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """Key 0 has 10,000 of 30,000 rows, a NULL key 10,000 more, the rest are single."""
    key = (F.when(F.col("id") < N // 3, F.lit(0)).when(F.col("id") < 2 * N // 3, F.lit(None)).otherwise(F.col("id")))
    return spark.range(0, N, 1, 8).select(key.alias("k"), F.col("id").alias("v"), (F.col("id") % 3).cast("int").alias("batch_id"))


def test_dedup(hot):
    out = dedup(hot, ["k"], ["v"])
    assert out.count() == N // 3 + 2
    assert out.where("k = 0").first()["v"] == N // 3 - 1


def test_upsert_of_hot_target(spark, hot):
    work = spark.createDataFrame([(0, -1), (None, -2), (-5, -3)], "k long, v long")
    for small in (True, False):
        out = merge.scd1(hot.select("k", "v"), work, ["k"], small_work=small)
        assert out.count() == N + 2
        assert out.where("k = 0 and v = -1").count() == N // 3
        assert out.where("k is null").count() == N // 3 + 1


def test_history_of_hot_target(spark, hot):
    target = with_history(hot.select("k", "v"), "2024-01-01")
    work = spark.createDataFrame([(0, 5), (None, 5)], "k long, v long")
    out = merge.scd2(target, work, ["k"], "2024-02-01")
    # One of the hot rows holds the new value already, so it stays and no version is added.
    assert out.where("k = 0 and is_current").count() == 1 and out.where("k = 0").count() == N // 3
    assert out.where("k is null and is_current").count() == N // 3 + 1


def test_hot_null_keys_go_around_the_join(spark, hot):
    rest = merge.anti_join(hot, spark.range(1).select(F.lit(0).cast("long").alias("k")), ["k"])
    assert rest.count() == 2 * N // 3
    plan = rest._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.count("LeftAnti") == 1


def test_replay_of_hot_key(spark, hot):
    empty = with_history(hot.select("k", "v"), "2024-01-01").limit(0)
    out = replay_scd2(empty, hot, ["k"], {n: f"2024-0{n + 1}-01" for n in range(3)}, newest=["v"])
    assert out.where("k = 0").count() == 3 and out.where("k = 0 and is_current").count() == 1
    assert out.where("k > 0").count() == N // 3


def test_fold_of_hot_job(spark):
    events = spark.range(0, N, 1, 8).select(
        F.when(F.col("id") < N // 2, 1).otherwise(F.col("id")).alias("batch_id"), F.lit(1).alias("job_id"),
        F.col("id").alias("seq"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("x"))
    out = fold(events)
    assert out.where("batch_id = 1").first()["x"] == (N // 2 - 1) // 7 * 7
    assert "partial_max_by" in out._jdf.queryExecution().executedPlan().toString()
