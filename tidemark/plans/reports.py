"""Reports on the ledger, the settings and the targets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ledger import FAILED, STEPS, SUCCESS

_ROWS = "rows_extracted"


def _count_where(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def run_stats(state: DataFrame) -> DataFrame:
    """Successful runs per table: how many, how long, how many rows, first and last."""
    return state.where(F.col("final_status") == SUCCESS).groupBy("source_table").agg(
        F.count(F.lit(1)).alias("total_runs"), F.avg("job_duration").alias("avg_duration_sec"),
        F.sum(_ROWS).alias("total_rows_moved"), F.min("job_start_time").alias("first_run"),
        F.max("job_end_time").alias("last_run"))


def success_rate(state: DataFrame) -> DataFrame:
    good = F.count_if(F.col("final_status") == SUCCESS)
    total = F.count(F.lit(1))
    percent = F.when(total > 0, F.round(good * F.lit(100.0) / total, 1).cast("double"))
    return state.agg(total.alias("total_jobs"), good.alias("succeeded"),
                     _count_where(F.col("final_status") == FAILED, "failed"), percent.alias("success_rate_pct"))


def daily_volume(state: DataFrame) -> DataFrame:
    return (state.where(F.col("final_status") == SUCCESS).groupBy(F.to_date("job_start_time").alias("run_date"))
            .agg(F.count(F.lit(1)).alias("tables_processed"), F.sum(_ROWS).alias("total_rows_extracted"),
                 F.sum("target_count").alias("total_rows_loaded"), F.sum("job_duration").alias("total_duration_sec"))
            .orderBy(F.desc("run_date")))


def run_kpis(state: DataFrame) -> DataFrame:
    """All runs in one row; runs without a duration do not count for the mean."""
    return state.agg(F.count(F.lit(1)).alias("total"), _count_where(F.col("final_status") == SUCCESS, "successful"),
                     _count_where(F.col("final_status") == FAILED, "failed"),
                     F.avg("job_duration").alias("avg_duration"))


def batch_summary(state: DataFrame) -> DataFrame:
    """Per batch: results, and the longest job as the time the batch took."""
    return state.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total"), _count_where(F.col("final_status") == SUCCESS, "success"),
        _count_where(F.col("final_status") == FAILED, "failed"), F.max("job_duration").alias("wall_time"))


def movement_reduction(state: DataFrame) -> DataFrame:
    """Per table: mean rows moved by a full and by an incremental run, and the share saved."""
    sides = (state.where(F.col("final_status") == SUCCESS).groupBy("source_table")
             .pivot("load_type", ["FULL", "INCREMENTAL"]).agg(F.avg(_ROWS)))
    saved = F.when(F.col("FULL") > 0, F.round((F.lit(1.0) - F.col("INCREMENTAL") / F.col("FULL")) * 100, 1))
    return sides.select("source_table", F.col("FULL").alias("full_rows"),
                        F.col("INCREMENTAL").alias("incremental_rows"), saved.alias("reduction_pct"))


def full_vs_incremental(state: DataFrame, tables: list[str]) -> DataFrame:
    """The runs of some tables side by side, oldest first."""
    return (state.where(F.col("source_table").isin(tables))
            .select("batch_id", "source_table", "load_type", F.col(_ROWS).alias("rows_moved"),
                    F.col("job_duration").alias("seconds"), "job_start_time")
            .orderBy("job_start_time"))


def delta_summary(state: DataFrame) -> DataFrame:
    """Per run: the counts that are not zero, in words."""
    parts = [F.when(F.col(f"rows_{word}") > 0, F.concat(F.col(f"rows_{word}").cast("string"), F.lit(f" {word}")))
             for word in ("extracted", "inserted", "updated", "expired")]
    text = F.concat_ws(" · ", *parts)
    return state.select("batch_id", "job_id", "source_table",
                        F.when(text == "", F.lit("no changes")).otherwise(text).alias("summary"))


def job_summary(state: DataFrame) -> DataFrame:
    return state.select(
        "batch_id", "job_id", "source_table", "target_table", F.col("execution_mode").alias("mode"), "load_type",
        F.col("source_count").alias("source_rows"), F.col("target_count").alias("target_rows"),
        F.col("final_status").alias("status"), F.col("job_duration").alias("duration_sec"),
        "job_start_time", "job_end_time").orderBy("batch_id", "job_id")


def step_status(state: DataFrame) -> DataFrame:
    return state.select("batch_id", "job_id", "source_table", *[F.col(f"{s}_status").alias(s) for s in STEPS],
                        "final_status").orderBy("batch_id", "job_id")


def merge_statements(state: DataFrame, n: int = 3) -> DataFrame:
    """What the last runs did to their targets."""
    return (state.where(F.col("merge_statement").isNotNull()).orderBy(F.desc("batch_id"), "job_id")
            .limit(n).select("batch_id", "job_id", "source_table", "merge_statement"))


def latest_runs(state: DataFrame, n: int = 5) -> DataFrame:
    return state.orderBy(F.desc("batch_id"), "job_id").limit(n).select(
        "batch_id", "job_id", "source_table", "execution_mode", "load_type", _ROWS,
        F.col("target_count").alias("target_total"), "final_status", "job_duration")


HISTORY_VIEW = ["batch_id", "job_id", "source_table", "target_table", "execution_mode", "load_type",
                "final_status", "source_count", "target_count", "rows_extracted", "rows_inserted",
                "rows_updated", "rows_expired", "job_duration"]


def run_history(state: DataFrame) -> DataFrame:
    """All runs, newest batch first, with the columns that this ledger has."""
    return (state.orderBy(F.desc("batch_id"), "job_id")
            .select(*[c for c in HISTORY_VIEW if c in state.columns]))


def shortened(rows: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Long texts of a report cut to so many characters; what the ledger holds stays whole."""
    return rows.withColumns({c: F.substring(c, 1, n) for c, n in limits.items() if c in rows.columns})


def run_texts(state: DataFrame, cut: int = 100) -> DataFrame:
    """Per run: the texts it left in the ledger, short enough for a table on a screen."""
    texts = [c for c in ("export_path", "export_log", "copy_log", "merge_log", "merge_statement") if c in state.columns]
    return (shortened(state.select("batch_id", "job_id", "source_table", *texts), dict.fromkeys(texts, cut))
            .orderBy(F.desc("batch_id"), "job_id"))


def config_kpis(config: DataFrame) -> DataFrame:
    active = F.count_if(F.col("enabled") == "Y")
    total = F.count(F.lit(1))
    return config.agg(total.alias("total"), active.alias("active"), (total - active).alias("inactive"),
                      _count_where(F.col("load_type") == "INCREMENTAL", "incremental"))


def history_summary(target: DataFrame) -> DataFrame:
    """Rows of a history target: all, current, closed."""
    return target.agg(F.count(F.lit(1)).alias("total_rows"), _count_where(F.col("is_current"), "current_rows"),
                      _count_where(~F.col("is_current"), "historical_rows"))


def key_history(target: DataFrame, condition: Column | str, columns: list[str], key: str) -> DataFrame:
    """All versions of some keys, newest first."""
    return (target.where(condition).select(key, *columns, "is_current", "eff_start_date", "eff_end_date")
            .orderBy(key, F.desc("eff_start_date")))


def price_history(target: DataFrame, key: str, price: str) -> DataFrame:
    """Closed prices beside the current price of the same row."""
    old = target.where(~F.col("is_current")).select(key, F.col(price).alias("old_price"),
                                                    F.col("eff_end_date").alias("changed_at"))
    new = target.where("is_current").select(key, F.col(price).alias("new_price"))
    return old.join(new, key)


def counted(tables: dict[str, DataFrame]) -> DataFrame:
    """One labelled row count per table; a history table counts its current rows."""
    parts = []
    for name, df in tables.items():
        rows = df.where("is_current") if "is_current" in df.columns else df
        parts.append(rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count"))
    return reduce(DataFrame.unionByName, parts)


def recent_changes(tables: dict[str, tuple[DataFrame, str]], since) -> DataFrame:
    """Rows per table whose change column is not before a moment."""
    at = F.lit(str(since)).cast("timestamp_ntz")
    return counted({n: df.where(F.col(c) >= at) for n, (df, c) in tables.items()}).withColumnRenamed(
        "row_count", "n_changed")


def newest_rows(df: DataFrame, change_column: str, key: str, n: int = 10) -> DataFrame:
    """The rows changed last: a sort that keeps n rows per task."""
    return df.orderBy(F.desc(change_column), key).limit(n)


def lookup(df: DataFrame, column: str, values: list) -> DataFrame:
    """The rows with one of some values, to verify a load."""
    return df.where(F.col(column).isin(values))


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Labelled counts of both sides joined by table, with the difference and a match flag."""
    left = source.withColumnRenamed("row_count", "source_count")
    right = target.withColumnRenamed("row_count", "target_count")
    diff = F.coalesce("target_count", F.lit(0)) - F.coalesce("source_count", F.lit(0))
    return (left.join(right, "table_name", "full").select("table_name", "source_count", "target_count",
                                                          diff.alias("difference"), (diff == 0).alias("matches")))
