"""Reports on the ledger."""

from pyspark.sql import Window, functions as F

from checks.common import LEDGER, check, ledger
from tidemark.plans import reports


@check(f"""WITH {LEDGER} SELECT source_table, count(*) AS total_runs, avg(job_duration) AS avg_duration_sec,
            CAST(sum(rows_extracted) AS BIGINT) AS total_rows_moved, min(job_start_time) AS first_run,
            max(job_end_time) AS last_run FROM ledger WHERE final_status = 'SUCCESS' GROUP BY ALL""")
def run_stats_by_table(spark, sf):
    return reports.run_stats(ledger(spark, sf))


@check(f"""WITH {LEDGER} SELECT count(*) AS total_jobs, count(*) FILTER (WHERE final_status = 'SUCCESS') AS succeeded,
            count(*) FILTER (WHERE final_status = 'FAILED') AS failed,
            CAST(round(count(*) FILTER (WHERE final_status = 'SUCCESS') * 100.0 / count(*), 1) AS DOUBLE)
              AS success_rate_pct FROM ledger""")
def success_rate(spark, sf):
    return reports.success_rate(ledger(spark, sf))


@check(f"""WITH {LEDGER} SELECT CAST(job_start_time AS DATE) AS run_date, count(*) AS tables_processed,
            CAST(sum(rows_extracted) AS BIGINT) AS total_rows_extracted,
            CAST(sum(target_count) AS BIGINT) AS total_rows_loaded,
            CAST(sum(job_duration) AS BIGINT) AS total_duration_sec,
            CAST(row_number() OVER (ORDER BY run_date DESC) AS INTEGER) AS position
          FROM ledger WHERE final_status = 'SUCCESS' GROUP BY run_date""")
def daily_volume(spark, sf):
    """One row a day, newest first: the place of each row is compared too."""
    placed = reports.daily_volume(ledger(spark, sf)).withColumn("place", F.monotonically_increasing_id())
    return placed.withColumn("position", F.row_number().over(Window.orderBy("place"))).drop("place")


@check(f"""WITH {LEDGER} SELECT count(*) AS total, count(*) FILTER (WHERE final_status = 'SUCCESS') AS successful,
            count(*) FILTER (WHERE final_status = 'FAILED') AS failed, avg(job_duration) AS avg_duration FROM ledger""")
def run_kpis(spark, sf):
    return reports.run_kpis(ledger(spark, sf))


@check(f"""WITH {LEDGER} SELECT batch_id, count(*) AS total, count(*) FILTER (WHERE final_status = 'SUCCESS') AS success,
            count(*) FILTER (WHERE final_status = 'FAILED') AS failed, max(job_duration) AS wall_time
          FROM ledger GROUP BY ALL""")
def batch_summary(spark, sf):
    return reports.batch_summary(ledger(spark, sf))


@check(f"""WITH {LEDGER}, sides AS (SELECT source_table, avg(rows_extracted) FILTER (WHERE load_type = 'FULL') AS full_rows,
            avg(rows_extracted) FILTER (WHERE load_type = 'INCREMENTAL') AS incremental_rows
            FROM ledger WHERE final_status = 'SUCCESS' GROUP BY ALL)
          SELECT *, CASE WHEN full_rows > 0 THEN round((1 - incremental_rows / full_rows) * 100, 1) END AS reduction_pct
          FROM sides""")
def movement_reduction(spark, sf):
    return reports.movement_reduction(ledger(spark, sf))


@check(f"""WITH {LEDGER} SELECT batch_id, source_table, load_type, rows_extracted AS rows_moved,
            job_duration AS seconds, job_start_time FROM ledger WHERE source_table IN ('click', 'purchase')""")
def full_vs_incremental(spark, sf):
    return reports.full_vs_incremental(ledger(spark, sf), ["click", "purchase"])


@check(f"""WITH {LEDGER}, words AS (SELECT batch_id, job_id, source_table, concat_ws(' · ',
              CASE WHEN rows_extracted > 0 THEN rows_extracted || ' extracted' END,
              CASE WHEN rows_inserted > 0 THEN rows_inserted || ' inserted' END,
              CASE WHEN rows_updated > 0 THEN rows_updated || ' updated' END,
              CASE WHEN rows_expired > 0 THEN rows_expired || ' expired' END) AS summary FROM ledger)
          SELECT * REPLACE (CASE WHEN summary = '' THEN 'no changes' ELSE summary END AS summary) FROM words""")
def delta_summary(spark, sf):
    return reports.delta_summary(ledger(spark, sf))


@check(f"""WITH {LEDGER} SELECT batch_id, job_id, source_table, execution_mode, load_type, rows_extracted,
            target_count AS target_total, final_status, job_duration FROM ledger ORDER BY batch_id DESC, job_id LIMIT 5""")
def latest_runs(spark, sf):
    return reports.latest_runs(ledger(spark, sf))


@check(f"""WITH {LEDGER} SELECT batch_id, job_id, source_table, merge_statement FROM ledger
          WHERE merge_statement IS NOT NULL ORDER BY batch_id DESC, job_id LIMIT 3""")
def merge_statements(spark, sf):
    return reports.merge_statements(ledger(spark, sf))


@check(f"""WITH {LEDGER} SELECT batch_id, job_id, source_table, target_table, execution_mode AS mode, load_type,
            source_count AS source_rows, target_count AS target_rows, final_status AS status,
            job_duration AS duration_sec, job_start_time, job_end_time FROM ledger""")
def job_summary(spark, sf):
    return reports.job_summary(ledger(spark, sf))


@check(f"""WITH {LEDGER} SELECT batch_id, job_id, source_table, target_table, execution_mode, load_type, final_status,
            source_count, target_count, rows_extracted, rows_inserted, rows_updated, rows_expired, job_duration
          FROM ledger""")
def run_history(spark, sf):
    return reports.run_history(ledger(spark, sf))


@check(f"""WITH {LEDGER} SELECT batch_id, job_id, source_table, CASE WHEN execution_mode = 'LOAD' THEN 'SKIPPED' END
            AS "export", CASE WHEN execution_mode = 'EXPORT' THEN 'SKIPPED' END AS "merge", final_status FROM ledger""")
def step_status(spark, sf):
    from checks.runs import runs
    from pyspark.sql import functions as F
    state = ledger(spark, sf).withColumns({f"{s}_status": F.lit(None).cast("string") for s in runs.STEPS})
    return reports.step_status(runs.skip_marks(state)).select(
        "batch_id", "job_id", "source_table", "export", "merge", "final_status")
