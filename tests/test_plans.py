"""What plans and rewrites must not do again: read a target twice, gather NULL keys, rewrite untouched months."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.types import column_metadata, target_schema
from tidemark.operators import merge
from tidemark.operators.target import Target, add_to_ranges
from tidemark.plans.replay import replay_scd1
from tidemark.session import workspace
from tidemark.sources import discover, tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _written(spark, df):
    path = workspace(spark, "plan")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_upsert_reads_each_side_once(spark):
    target = _written(spark, spark.range(100).withColumn("v", F.lit("a")))
    work = _written(spark, spark.range(50, 150).withColumn("v", F.lit("b")))
    plan = _plan(merge.scd1(target, work, ["id"]))
    assert plan.count("FileScan parquet") == 2 and plan.count("Join ") == 1
    batches = work.withColumn("batch_id", F.lit(1))
    replayed = _plan(replay_scd1(target, batches, ["id"]))
    assert replayed.count("FileScan parquet") == 2 and replayed.count("+- Window [") == 1


def test_null_keys_are_spread_and_match_nothing(spark):
    target = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    work = spark.range(10).select(F.when(F.col("id") > 4, F.col("id") * 2).alias("k"), (-F.col("id")).alias("v"))
    out = merge.scd1(target, work, ["k"])
    assert out.count() == 4005 and out.filter("k is null").count() == 2005
    spread = merge._as_target(target, ["k"]).filter("k is null").groupBy("_spread").count()
    assert spread.agg(F.max("count")).first()[0] < 20


def test_loads_rewrite_only_the_months_they_touch(spark):
    rows = spark.range(3650).select(
        F.col("id"), F.date_add(F.lit("2015-01-01").cast("date"), F.col("id").cast("int")).alias("day"), F.lit("a").alias("v"))
    schema = target_schema(column_metadata(rows))
    target = Target(spark, workspace(spark, "t")).create(schema, ["id", "day"], 2, "day")
    target.load(_written(spark, rows), "incremental", 1, ["id", "day"], datetime(2024, 1, 1))
    before = set(target._load()["segments"])
    change = _written(spark, rows.filter("day >= '2018-03-01' and day < '2018-04-01'").withColumn("v", F.lit("b")))
    counts = target.load(change, "incremental", 1, ["id", "day"], datetime(2024, 1, 2))
    after = set(target._load()["segments"])
    assert counts.rows_updated == 31 and counts.rows_inserted == 0
    assert len(before - after) <= 2 and len(before) > 200
    assert target.read().filter("v = 'b'").count() == 31 and target.count() == 3650
    history = Target(spark, workspace(spark, "h")).create(target_schema(column_metadata(rows), history=True), ["id", "day"], 1, "day")
    history.load(_written(spark, rows), "incremental", 2, ["id", "day"], datetime(2024, 1, 1))
    live = {s for s in history._load()["segments"] if s.kind == "live"}
    counts = history.load(change, "incremental", 2, ["id", "day"], datetime(2024, 1, 2))
    assert counts.rows_expired == 31 and counts.rows_inserted == 31
    assert len(live - {s for s in history._load()["segments"] if s.kind == "live"}) == 1
    with pytest.raises(ValueError):
        Target(spark, workspace(spark, "bad")).create(schema, ["id"], 1, "day")


def test_large_loads_give_the_same_as_small_ones(spark, monkeypatch):
    rows = spark.range(500).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("k"), F.lit("a").alias("v"))
    change = _written(spark, spark.range(400, 700).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("k"), F.lit("b").alias("v")))
    got = []
    for limit in (merge.BROADCAST_BYTES, -1):
        monkeypatch.setattr(merge, "BROADCAST_BYTES", limit)
        target = Target(spark, workspace(spark, "t")).create(target_schema(column_metadata(rows)), ["k"], 3)
        target.append(rows)
        counts = target.upsert(change, ["k"])
        got.append((counts, sorted(map(tuple, target.read().collect()), key=str)))
    assert got[0] == got[1] and got[0][0].rows_updated == 98


def test_updates_move_rows_between_open_and_closed(spark):
    rows = spark.range(6).withColumn("v", F.lit("a"))
    target = Target(spark, workspace(spark, "t")).create(target_schema(column_metadata(rows), history=True), ["id"])
    target.track(_written(spark, rows), datetime(2024, 1, 1))
    target.update("id < 2", {"is_current": F.lit(False)})
    assert target.current().count() == 4
    target.update("id < 1", {"is_current": F.lit(True)})
    assert target.current().count() == 5 and target.read().count() == 6


def test_a_published_view_follows_the_target(spark):
    rows = spark.range(3).withColumn("v", F.lit("a"))
    target = Target(spark, workspace(spark, "t")).create(target_schema(column_metadata(rows)), ["id"])
    target.publish("published_view")
    assert spark.table("published_view").count() == 0
    target.append(rows)
    target.publish("published_view")
    assert spark.table("published_view").count() == 3 and spark.table("published_view").columns == ["id", "v"]
    spark.sql("DROP VIEW published_view")


def test_ranges():
    assert add_to_ranges([], [3, 1, 2]) == [[1, 3]]
    assert add_to_ranges([[1, 3], [7, 9]], [5]) == [[1, 3], [5, 5], [7, 9]]
    assert add_to_ranges([[1, 3], [5, 9]], [4, 4]) == [[1, 9]]


def test_variants_come_back_from_the_stage(spark):
    from tidemark.sources import staged
    rows = spark.range(3).select("id", F.parse_json(F.concat(F.lit('{"a": ['), F.col("id"), F.lit('], "b": "x|\\"y"}'))).alias("x"))
    schema = target_schema(column_metadata(rows))
    folder = workspace(spark, "stage")
    staged.write_staged(rows, folder)
    back = staged.check_rows(staged.read_text(spark, folder, schema), schema)
    assert back.filter("_reason is not null").count() == 0
    want = {(r[0], r[1]) for r in rows.select("id", F.to_json("x")).collect()}
    assert {(r[0], r[1]) for r in back.select("id", F.to_json("x")).collect()} == want


def test_catalog_tables_and_their_reader(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS found_db")
    spark.range(7).withColumn("updated_at", F.lit("2024-01-01").cast("timestamp_ntz")).write.mode("overwrite").saveAsTable("found_db.things")
    found = discover.catalog_tables(spark, "found_db")
    assert list(found) == ["things"] and tables.catalog_reader(spark)({"source_db": "found_db", "source_table": "things"}).count() == 7
    suggested = discover.suggest_jobs(discover.profile_keys(found), discover.profile_watermarks(found),
                                      spark.createDataFrame([("things",)], "table_name string"), "found_db").first()
    assert (suggested["primary_key"], suggested["cdc_columns"], suggested["load_type"]) == ("id", "updated_at", "incremental")
    spark.sql("DROP DATABASE found_db CASCADE")


def test_keys_are_counted_exactly_only_where_it_matters(spark):
    found = {"t": spark.range(1000).select("id", (F.col("id") % 7).alias("kind_id"), (F.col("id") * 999 / 1000).cast("long").alias("near_id"))}
    got = {r["column_name"]: r for r in discover.find_keys(found).collect()}
    assert got["id"]["is_key"] and got["kind_id"]["n_distinct"] is None and not got["kind_id"]["is_key"]
    assert not got["near_id"]["is_key"] and got["near_id"]["n_distinct"] == 999


def test_discovery_without_candidates(spark):
    bare = {"t": spark.range(3).withColumnRenamed("id", "n").withColumn("created_at", F.current_timestamp().cast("timestamp_ntz"))}
    keys, marks = discover.profile_keys(bare), discover.profile_watermarks(bare)
    assert keys.count() == 0
    names = spark.createDataFrame([("t",)], "table_name string")
    assert discover.suggest_jobs(keys, marks, names, "s").first()["load_type"] == "full"
    assert discover.profile_watermarks({"u": spark.range(2)}).count() == 0


def test_custom_query_with_a_filter_load(spark):
    from tidemark.operators.ledger import Ledger
    from tidemark.plans import job as jobs
    root = workspace(spark, "job")
    rows = spark.range(10).withColumn("part", F.col("id") % 2)
    place = jobs.Place(spark, lambda job: rows, f"{root}/stage", f"{root}/targets", Ledger(spark, f"{root}/ledger"),
                       custom_tables={"t": rows})
    job = {"source_db": "s", "source_schema": "d", "source_table": "t", "target_table": "T", "load_type": "filter",
           "custom_sql": "SELECT id, part FROM {t} WHERE part = 1", "filter_condition": "part = 1"}
    for batch in (10000, 10001):
        assert jobs.run_table(place, job, "FULL", batch, datetime(2024, 1, 1))["status"] == "SUCCESS"
    assert sorted(int(r[0]) for r in place.target(job).read().collect()) == [1, 3, 5, 7, 9]
