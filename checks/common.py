"""Registration of checks and inputs several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def check(sql: str | None = None):
    """Register a query under its function name."""
    def keep(fn):
        REGISTRY[fn.__name__] = (fn, sql)
        return fn
    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

# -- a run log made from all events: one event is one job run ---------------------------


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    whole = F.floor("value").cast("long")
    mode = F.when(F.col("value") < 20, "EXPORT").when(F.col("value") < 60, "FULL").otherwise("LOAD")
    status = F.when(F.col("value") < 5, "FAILED").when(F.col("value") <= 150, "SUCCESS")
    return e.select(
        (F.lit(10000) + F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))).cast("long").alias("batch_id"),
        F.col("event_id").alias("job_id"), F.lit("sales").alias("source_db"), F.lit("dbo").alias("source_schema"),
        F.col("event_type").alias("source_table"), F.upper("event_type").alias("target_table"),
        F.when(F.col("user_id") < 50, "FULL").otherwise("INCREMENTAL").alias("load_type"),
        mode.alias("execution_mode"), status.alias("final_status"), F.col("ts").alias("job_start_time"),
        F.when(status.isNotNull(), F.timestamp_add("SECOND", whole, F.col("ts"))).alias("job_end_time"),
        F.when(status.isNotNull(), whole).alias("job_duration"),
        F.timestamp_add("DAY", F.lit(-1), F.col("ts")).alias("window_start"), F.col("ts").alias("window_end"),
        F.col("event_id").alias("max_id"), (whole * 10).alias("rows_extracted"),
        F.floor(F.col("value") / 2).cast("long").alias("rows_inserted"),
        F.when(F.col("user_id") < 30, F.lit(0)).otherwise(F.col("user_id")).cast("long").alias("rows_updated"),
        F.when(F.col("event_type") == "click", whole).otherwise(F.lit(0)).cast("long").alias("rows_expired"),
        (F.col("user_id") * 100).alias("target_count"), (F.col("user_id") * 100 + whole).alias("source_count"),
        F.concat_ws("/", "event_type", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
        .alias("export_path"),
        F.when((mode != "EXPORT") & (status == "SUCCESS"), "YES").otherwise("NO").alias("ingestion_completed"),
        F.when(status == "SUCCESS", F.concat(F.lit("merge "), F.col("props"))).alias("merge_statement"))


LEDGER = """ledger AS (
  SELECT 10000 + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS batch_id, event_id AS job_id,
    'sales' AS source_db, 'dbo' AS source_schema, event_type AS source_table, upper(event_type) AS target_table,
    CASE WHEN user_id < 50 THEN 'FULL' ELSE 'INCREMENTAL' END AS load_type,
    CASE WHEN value < 20 THEN 'EXPORT' WHEN value < 60 THEN 'FULL' ELSE 'LOAD' END AS execution_mode,
    CASE WHEN value < 5 THEN 'FAILED' WHEN value <= 150 THEN 'SUCCESS' END AS final_status,
    ts AS job_start_time,
    CASE WHEN value <= 150 THEN ts + to_seconds(CAST(floor(value) AS BIGINT)) END AS job_end_time,
    CASE WHEN value <= 150 THEN CAST(floor(value) AS BIGINT) END AS job_duration,
    ts - INTERVAL 1 DAY AS window_start, ts AS window_end, event_id AS max_id,
    CAST(floor(value) AS BIGINT) * 10 AS rows_extracted, CAST(floor(value / 2) AS BIGINT) AS rows_inserted,
    CASE WHEN user_id < 30 THEN 0 ELSE user_id END AS rows_updated,
    CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS rows_expired,
    user_id * 100 AS target_count, user_id * 100 + CAST(floor(value) AS BIGINT) AS source_count,
    event_type || '/' || CAST(user_id AS VARCHAR) || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS export_path,
    CASE WHEN value >= 20 AND value >= 5 AND value <= 150 THEN 'YES' ELSE 'NO' END AS ingestion_completed,
    CASE WHEN value >= 5 AND value <= 150 THEN 'merge ' || props END AS merge_statement
  FROM events)"""
