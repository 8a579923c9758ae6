"""The run ledger: append-only events, folded to the latest state of each job.

One event row carries the values that became known at that moment and NULL elsewhere.
The state of a job in a batch is, per column, the last value that was set.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import fs

# Steps in running order, their marks and the first batch id.
EXTRACT_STEPS = ["export", "upload"]
LOAD_STEPS = ["create_table", "create_stage", "copy", "merge", "audit"]
SUCCESS = "SUCCESS"
FAILED = "FAILED"
SKIPPED = "SKIPPED"
SUPERSEDED = "SUPERSEDED"
FAILED_BEFORE = "FAILED IN PREVIOUS STEP"
FIRST_BATCH = 10000
EXTRACTING_MODES = ["FULL", "EXPORT"]

STEPS = EXTRACT_STEPS + LOAD_STEPS
_TEXT = ["source_db", "source_schema", "source_table", "target_db", "target_schema", "target_table",
         "load_type", "stage_path", "execution_mode", "export_path", "custom_sql", "merge_statement",
         "final_status", "ingestion_completed"]
_COUNTS = ["source_count", "target_count", "rows_extracted", "rows_rejected", "rows_inserted",
           "rows_updated", "rows_expired", "job_duration", "max_id"]
_TIMES = ["window_start", "window_end", "job_start_time", "job_end_time"]

ID_FIELDS = [T.StructField("batch_id", T.LongType()), T.StructField("job_id", T.LongType())]
VALUE_FIELDS = ([T.StructField(n, T.StringType()) for n in _TEXT]
                + [T.StructField(n, T.LongType()) for n in _COUNTS]
                + [T.StructField(n, T.TimestampNTZType()) for n in _TIMES]
                + [T.StructField(f"{s}_{k}", T.StringType()) for s in STEPS for k in ("status", "log")])
EVENT_SCHEMA = T.StructType(ID_FIELDS + [T.StructField("seq", T.LongType())] + VALUE_FIELDS)
STATE_SCHEMA = T.StructType(ID_FIELDS + VALUE_FIELDS)
_DATED = T.StructType(ID_FIELDS + [T.StructField(f.name, T.StructType([T.StructField("at", T.LongType()), T.StructField(
    "value", f.dataType)])) for f in VALUE_FIELDS])


def fold(events: DataFrame, order: str = "seq") -> DataFrame:
    """Latest non-NULL value of every column per (batch, job). Partial maxima are taken map-side."""
    names = [c for c in events.columns if c not in ("batch_id", "job_id", order)]
    return events.groupBy("batch_id", "job_id").agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in names])


def dated(events: DataFrame, order: str = "seq") -> DataFrame:
    """Every value as (value, when it was set), NULL where the event sets nothing: what partial folds are made of."""
    names = [c for c in events.columns if c not in ("batch_id", "job_id", order)]
    return events.select("batch_id", "job_id", *[
        F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("at"), F.col(c).alias("value"))).alias(c) for c in names])


def merged(parts: DataFrame) -> DataFrame:
    """Partial folds added up, in the same form."""
    names = [c for c in parts.columns if c not in ("batch_id", "job_id")]
    return parts.groupBy("batch_id", "job_id").agg(*[F.max(c).alias(c) for c in names])


def plain(folded: DataFrame) -> DataFrame:
    """The values of a fold without their times."""
    return folded.select("batch_id", "job_id", *[F.col(f"{c}.value").alias(c) for c in folded.columns
                                                 if c not in ("batch_id", "job_id")])


def next_batch_id(ledger: DataFrame) -> DataFrame:
    """One row: the id after the highest batch, or the first id for an empty ledger."""
    return ledger.agg(F.coalesce(F.max("batch_id") + 1, F.lit(FIRST_BATCH).cast("long")).alias("batch_id"))


def _table_key() -> list[str]:
    return ["source_db", "source_schema", "source_table"]


def watermarks(state: DataFrame, status: str = "final_status") -> DataFrame:
    """Per source table: window and highest id of the last run that extracted with success."""
    done = state.where((F.col(status) == SUCCESS) & F.col("execution_mode").isin(EXTRACTING_MODES))
    last = F.max_by(F.struct("batch_id", "window_start", "window_end", "max_id"), F.struct("batch_id", "job_id"))
    return done.groupBy(*_table_key()).agg(last.alias("w")).select(*_table_key(), "w.*")


def time_watermarks(state: DataFrame) -> DataFrame:
    """Per source table: the latest start of a successful run that extracted."""
    return (state.where((F.col("final_status") == SUCCESS) & F.col("execution_mode").isin(EXTRACTING_MODES))
            .groupBy(*_table_key()).agg(F.max("job_start_time").alias("watermark")))


def id_watermarks(state: DataFrame) -> DataFrame:
    """Per source table: the highest id any successful extract has seen."""
    return (state.where((F.col("final_status") == SUCCESS) & F.col("execution_mode").isin(EXTRACTING_MODES))
            .groupBy(*_table_key()).agg(F.max("max_id").alias("last_id")))


def cascade(state: DataFrame) -> DataFrame:
    """After the first failed step every later step reads as failed before, and the job as failed."""
    failed: Column = F.lit(False)
    marks = {}
    for step in STEPS:
        status = F.col(f"{step}_status")
        marks[f"{step}_status"] = F.when(failed, F.lit(FAILED_BEFORE)).otherwise(status)
        failed = failed | F.coalesce(status == FAILED, F.lit(False))
    marks["final_status"] = F.when(failed, F.lit(FAILED)).otherwise(F.col("final_status"))
    marks["ingestion_completed"] = F.when(failed, F.lit("NO")).otherwise(F.col("ingestion_completed"))
    return state.withColumns(marks)


def skip_marks(state: DataFrame) -> DataFrame:
    """EXPORT runs skip the load steps and leave the data pending; LOAD runs skip the extract steps."""
    mode = F.upper("execution_mode")
    marks = {f"{s}_status": F.when(mode == "EXPORT", F.lit(SKIPPED)).otherwise(F.col(f"{s}_status"))
             for s in LOAD_STEPS}
    marks |= {f"{s}_status": F.when(mode.isin("LOAD", "INGEST"), F.lit(SKIPPED)).otherwise(F.col(f"{s}_status"))
              for s in EXTRACT_STEPS}
    marks["ingestion_completed"] = F.when(mode == "EXPORT", F.lit("NO")).otherwise(F.col("ingestion_completed"))
    return state.withColumns(marks)


def with_duration(state: DataFrame) -> DataFrame:
    """Whole seconds between start and end."""
    seconds = F.expr("timestampdiff(SECOND, job_start_time, job_end_time)").cast("long")
    return state.withColumn("job_duration", seconds)


def create_batch(jobs: DataFrame, state: DataFrame, mode: str | None = None) -> DataFrame:
    """One ledger row per enabled job under the next batch id, with the skip marks of its mode."""
    rows = jobs.where("enabled = 'Y'")
    if mode:
        rows = rows.withColumn("execution_mode", F.lit(mode.upper()))
    rows = rows.withColumns({"stage_path": F.col("cloud_path"), "batch_id": next_batch_id(state).scalar()})
    blank = {f.name: F.lit(None).cast(f.dataType) for f in STATE_SCHEMA if f.name not in rows.columns}
    return skip_marks(rows.withColumns(blank)).select(*STATE_SCHEMA.names)


def audit_rows(state: DataFrame, batch_id: int | None = None, job_id: int | None = None) -> DataFrame:
    """What the audit table keeps of finished runs: the ledger row with its extract window and id."""
    rows = state.where(F.col("final_status").isNotNull())
    if batch_id is not None:
        rows = rows.where(F.col("batch_id") == batch_id)
    if job_id is not None:
        rows = rows.where(F.col("job_id") == job_id)
    previous = {f"prev_extract_{edge}": F.lit(None).cast("timestamp_ntz") for edge in ("start", "end")}
    return rows.withColumns(previous).withColumnsRenamed(
        {"window_start": "extract_start", "window_end": "extract_end", "max_id": "cdc_id"})


def ingested(state: DataFrame) -> DataFrame:
    """Export paths that a later run has loaded, or that a later full export has taken the place of."""
    return (state.where(F.col("ingestion_completed").isin("YES", SUPERSEDED) & F.col("export_path").isNotNull())
            .select(*_table_key(), "export_path").distinct())


def pending_exports(state: DataFrame) -> DataFrame:
    """Successful exports that no run has loaded yet."""
    exports = state.where((F.col("final_status") == SUCCESS) & (F.col("execution_mode") == "EXPORT")
                          & F.col("export_path").isNotNull())
    return (exports.join(ingested(state), [*_table_key(), "export_path"], "left_anti")
            .select("batch_id", "job_id", *_table_key(), "export_path", "window_start", "window_end", "max_id"))


class Ledger:
    """Events on disk. Every append adds files; nothing is changed in place."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._checkpoints, self._old = f"{self.path}/_checkpoints", f"{self.path}/_old"

    def append(self, rows: DataFrame) -> None:
        # A folder of its own per append: jobs that end at the same time do not share a committer.
        # Columns an event does not set are left out of its file; the reader fills them with NULL.
        known = [f for f in EVENT_SCHEMA if f.name in rows.columns]
        (rows.select(*[F.col(f.name).cast(f.dataType) for f in known])
         .write.parquet(f"{self.path}/{uuid.uuid4().hex}"))

    def event(self, batch_id: int, job_id: int, seq: int, **values) -> None:
        """Append one event of one job. Texts are kept whole; ``reports.run_texts`` cuts what it shows."""
        values = {"batch_id": batch_id, "job_id": job_id, "seq": seq, **values}
        row = self.spark.range(1, numPartitions=1).select(*[
            F.lit(v).cast(EVENT_SCHEMA[n].dataType).alias(n) for n, v in values.items()])
        row.write.parquet(f"{self.path}/{uuid.uuid4().hex}")

    def exporters(self, paths: list[str]) -> dict[int, int]:
        """The job that wrote each of these exports, by batch id."""
        found = plain(self._folded("export_path")).where(F.col("export_path").isin(paths)).select("batch_id", "job_id")
        return {r["batch_id"]: r["job_id"] for r in found.collect()}  # one row per path

    def exported(self, job: dict) -> dict[int, datetime]:
        """Window end of every successful export of one source table, by batch id."""
        state = self._of_table(job, "export_status", "window_end").where(F.col("export_status") == SUCCESS)
        found = state.where("window_end is not null").groupBy("batch_id").agg(F.max("window_end").alias("end"))
        return {r["batch_id"]: r["end"] for r in found.collect()}  # one row per batch

    def events(self) -> DataFrame:
        """All events ever, those that a checkpoint holds too."""
        folders = [f for f in (self.path, self._old) if fs.exists(self.spark, f)]
        return self._read(folders)

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], EVENT_SCHEMA)
        return self.spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(*folders)

    def _folders(self) -> list[str]:
        return [n for n in fs.children(self.spark, self.path)
                if not n.startswith("_") and fs.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]

    def _manifests(self) -> dict[tuple[int, str], str]:
        """Checkpoints that are there, as (number, name of the state) -> file."""
        files = [n for n in fs.children(self.spark, self._checkpoints) if n.endswith(".json") and not n.startswith("_")]
        return {(int(n.split("-")[0]), n[:-5].split("-")[1]): n for n in files}

    def _parts(self) -> tuple[tuple[int, str], list[str], list[str]]:
        """Newest checkpoint ((0, "") if none), the event folders it covers that still lie in the log, and those written since."""
        while True:
            found = self._manifests()
            last = max(found, default=(0, ""))
            text = fs.read_text(self.spark, f"{self._checkpoints}/{found[last]}") if found else "[]"
            names = self._folders()
            if max(self._manifests(), default=(0, "")) == last:  # folders move only once a newer checkpoint is there
                covers = set(json.loads(text))
                return last, [n for n in names if n in covers], [n for n in names if n not in covers]

    def _folded(self, *columns: str) -> DataFrame:
        """The fold of these columns: the newest checkpoint and the events since, whatever the length of the log."""
        last, _, tail = self._parts()
        return self._fold_of(last, tail, columns)

    def _fold_of(self, last: tuple[int, str], tail: list[str], columns: tuple[str, ...] = ()) -> DataFrame:
        names = list(columns) or [f.name for f in VALUE_FIELDS]
        since = dated(self._read([f"{self.path}/{n}" for n in tail]).select("batch_id", "job_id", "seq", *names))
        if last[0]:
            since = since.unionByName(self.spark.read.schema(_DATED).parquet(f"{self._checkpoints}/state_{last[1]}")
                                      .select("batch_id", "job_id", *names))
        return merged(since)

    def checkpoint(self, at_least: int = 1) -> int | None:
        """Fold what was written since the last checkpoint into a new one, if that is ``at_least`` so many event folders.

        Its number is returned. A checkpoint is there once the list of what it covers is; one that dies halfway changes
        nothing, and of two that are made at once one is used. Event folders stay for one more checkpoint, for readers that
        listed them, and then move aside, so that the log keeps every event and listing it stays short.
        """
        last, covered, tail = self._parts()
        if len(tail) < at_least:
            return None
        number, name = last[0] + 1, uuid.uuid4().hex
        self._fold_of(last, tail).write.parquet(f"{self._checkpoints}/state_{name}")
        fs.write_text(self.spark, f"{self._checkpoints}/{number}-{name}.json", json.dumps([*covered, *tail]))
        for folder in covered:
            try:
                fs.move(self.spark, f"{self.path}/{folder}", f"{self._old}/{folder}")
            except Exception:  # another caller has moved it
                if fs.exists(self.spark, f"{self.path}/{folder}"):
                    raise
        for (n, state), file in self._manifests().items():
            if n < number - 1:
                fs.remove(self.spark, f"{self._checkpoints}/{file}")
                fs.remove(self.spark, f"{self._checkpoints}/state_{state}")
        return number

    def state(self) -> DataFrame:
        return cascade(plain(self._folded()))

    def _of_table(self, job: dict, *columns: str) -> DataFrame:
        state = plain(self._folded(*dict.fromkeys([*_table_key(), *columns])))
        for name in _table_key():
            state = state.where(F.col(name) == job[name])
        return state

    def write_audit(self, folder: str, batch_id: int, job_id: int) -> None:
        """Append what the audit table keeps of one run."""
        rows = audit_rows(self.state(), batch_id, job_id)
        rows.write.parquet(f"{folder.rstrip('/')}/{uuid.uuid4().hex}")

    def compact(self) -> None:
        """Write the events since the last checkpoint again as few files, then drop their old folders. Run while no job runs."""
        _, _, tail = self._parts()
        if not tail:
            return
        self.append(self._read([f"{self.path}/{n}" for n in tail]).hint("rebalance"))
        for name in tail:
            fs.remove(self.spark, f"{self.path}/{name}")

    def next_batch_id(self) -> int:
        return next_batch_id(self._folded("execution_mode")).first()["batch_id"]

    def watermark(self, job: dict) -> dict | None:
        """The last staged window of one source table, or None before its first extract.

        A run whose load failed counts: its files wait in the stage and go in with the next load, so
        extracting them again would load them twice.
        """
        state = self._of_table(job, "execution_mode", "export_status", "window_start", "window_end", "max_id")
        found = watermarks(state, "export_status").first()
        return found.asDict() if found else None
