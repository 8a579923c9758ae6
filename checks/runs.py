"""The run ledger."""

from pyspark.sql import functions as F

from checks.common import LEDGER, check, ledger, table
from checks.settings import CONFIG, config
from tidemark.operators import ledger as runs
from tidemark.plans import reports

# Every event is one update of the job (day, user): its kind says which column it sets.
_FOLDED = {
    "export_status": "CASE WHEN event_type = 'view' THEN CASE WHEN value < 10 THEN 'FAILED' ELSE 'SUCCESS' END END",
    "copy_status": "CASE WHEN event_type = 'click' THEN CASE WHEN value < 10 THEN 'FAILED' ELSE 'SUCCESS' END END",
    "merge_status": "CASE WHEN event_type = 'purchase' THEN CASE WHEN value < 10 THEN 'FAILED' ELSE 'SUCCESS' END END",
    "final_status": "CASE WHEN event_type = 'signup' THEN 'SUCCESS' END",
    "rows_extracted": "CASE WHEN event_type = 'error' THEN CAST(floor(value) AS BIGINT) END",
    "ingestion_completed": "CASE WHEN event_type = 'signup' THEN 'YES' END",
}
_EVENTS = ", ".join(f"{sql} AS {name}" for name, sql in _FOLDED.items())
_STATE = f"""ev AS (SELECT 10000 + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS batch_id, user_id AS job_id,
    event_id AS seq, {_EVENTS} FROM events),
  state AS (SELECT batch_id, job_id, {', '.join(
      f'arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}' for c in _FOLDED)} FROM ev GROUP BY ALL)"""


def _state(spark, sf):
    e = table(spark, sf, "events")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    rows = e.select((F.lit(10000) + day).cast("long").alias("batch_id"), F.col("user_id").alias("job_id"),
                    F.col("event_id").alias("seq"), *[F.expr(sql).alias(name) for name, sql in _FOLDED.items()])
    return runs.fold(rows)


@check(f"WITH {_STATE} SELECT * FROM state")
def job_state_fold(spark, sf):
    return _state(spark, sf)


@check(f"""WITH {_STATE}, marked AS (SELECT *, coalesce(export_status = 'FAILED', false) AS e,
            coalesce(copy_status = 'FAILED', false) AS c, coalesce(merge_status = 'FAILED', false) AS m FROM state)
          SELECT batch_id, job_id, export_status,
            CASE WHEN e THEN 'FAILED IN PREVIOUS STEP' ELSE copy_status END AS copy_status,
            CASE WHEN e OR c THEN 'FAILED IN PREVIOUS STEP' ELSE merge_status END AS merge_status,
            CASE WHEN e OR c OR m THEN 'FAILED IN PREVIOUS STEP' END AS audit_status,
            CASE WHEN e OR c OR m THEN 'FAILED' ELSE final_status END AS final_status,
            CASE WHEN e OR c OR m THEN 'NO' ELSE ingestion_completed END AS ingestion_completed FROM marked""")
def failure_cascade(spark, sf):
    state = _state(spark, sf)
    blank = {f"{s}_status": F.lit(None).cast("string") for s in runs.STEPS if f"{s}_status" not in state.columns}
    return runs.cascade(state.withColumns(blank)).select(
        "batch_id", "job_id", "export_status", "copy_status", "merge_status", "audit_status", "final_status",
        "ingestion_completed")


@check(f"""WITH {LEDGER} SELECT batch_id, job_id, execution_mode,
            CASE WHEN execution_mode = 'LOAD' THEN 'SKIPPED' END AS export_status,
            CASE WHEN execution_mode = 'LOAD' THEN 'SKIPPED' END AS upload_status,
            CASE WHEN execution_mode = 'EXPORT' THEN 'SKIPPED' END AS copy_status,
            CASE WHEN execution_mode = 'EXPORT' THEN 'SKIPPED' END AS merge_status,
            CASE WHEN execution_mode = 'EXPORT' THEN 'NO' ELSE ingestion_completed END AS ingestion_completed
          FROM ledger""")
def mode_skips(spark, sf):
    state = ledger(spark, sf).withColumns({f"{s}_status": F.lit(None).cast("string") for s in runs.STEPS})
    return runs.skip_marks(state).select("batch_id", "job_id", "execution_mode", "export_status", "upload_status",
                                         "copy_status", "merge_status", "ingestion_completed")


@check(f"""WITH {LEDGER}, {CONFIG} SELECT (SELECT coalesce(max(batch_id) + 1, 10000) FROM ledger) AS batch_id, source_db,
            source_schema, source_table, target_table, load_type, 'EXPORT' AS execution_mode, 'SKIPPED' AS copy_status,
            'NO' AS ingestion_completed FROM config WHERE enabled = 'Y'""")
def batch_create(spark, sf):
    from tidemark.sources.config import with_job_ids
    rows = runs.create_batch(with_job_ids(config(spark, sf)), ledger(spark, sf), "export")
    return rows.select("batch_id", "source_db", "source_schema", "source_table", "target_table", "load_type",
                       "execution_mode", "copy_status", "ingestion_completed")


@check(f"""WITH {LEDGER} SELECT batch_id, job_id, source_table, final_status, window_start AS extract_start,
            window_end AS extract_end, max_id AS cdc_id, CAST(NULL AS TIMESTAMP) AS prev_extract_start
          FROM ledger WHERE final_status IS NOT NULL""")
def audit_append(spark, sf):
    return runs.audit_rows(ledger(spark, sf)).select(
        "batch_id", "job_id", "source_table", "final_status", "extract_start", "extract_end", "cdc_id",
        "prev_extract_start")


@check(f"""WITH {LEDGER} SELECT batch_id, job_id, source_db, source_schema, source_table, export_path, window_start,
            window_end, max_id FROM ledger l WHERE final_status = 'SUCCESS' AND execution_mode = 'EXPORT'
          AND NOT EXISTS (SELECT 1 FROM ledger d WHERE d.ingestion_completed = 'YES'
            AND d.source_table = l.source_table AND d.export_path = l.export_path)""")
def pending_exports(spark, sf):
    return runs.pending_exports(ledger(spark, sf))


@check(f"""WITH {LEDGER} SELECT batch_id, job_id, CAST(date_diff('second', job_start_time, job_end_time) AS BIGINT)
            AS job_duration FROM ledger""")
def job_duration(spark, sf):
    return runs.with_duration(ledger(spark, sf).drop("job_duration")).select("batch_id", "job_id", "job_duration")


@check(f"""WITH {LEDGER} SELECT source_table, final_status, count(*) AS n FROM ledger GROUP BY ALL""")
def ledger_append_and_fold(spark, sf):
    """Runs written to the ledger as separate start and end events read back as one state."""
    from tidemark.session import workspace
    rows = ledger(spark, sf)
    book = runs.Ledger(spark, workspace(spark, "ledger"))
    keys = ["batch_id", "job_id"]
    book.append(rows.select(*keys, F.lit(1).alias("seq"), "source_db", "source_schema", "source_table", "job_start_time"))
    book.append(rows.select(*keys, F.lit(2).alias("seq"), "final_status", "job_end_time"))
    state = book.state()
    return state.groupBy("source_table", "final_status").agg(
        F.count(F.lit(1)).alias("n"))


@check(f"""WITH {LEDGER} SELECT batch_id, job_id, source_table, substr(export_path, 1, 12) AS export_path,
            substr(merge_statement, 1, 12) AS merge_statement FROM ledger""")
def run_texts(spark, sf):
    """Long texts of every run cut for a report."""
    return reports.run_texts(ledger(spark, sf), 12)
