"""Running jobs: extract to the stage, load from the stage, keep the ledger."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import fs
from tidemark.functions.predicates import FIRST_START, extract_condition, name_list
from tidemark.functions.types import HISTORY_COLUMNS, column_metadata, evolved, target_schema
from tidemark.operators.dedup import dedup
from tidemark.operators.ledger import FAILED, SKIPPED, EXTRACT_STEPS, LOAD_STEPS, SUCCESS, SUPERSEDED, Ledger
from tidemark.operators.merge import load_kind
from tidemark.operators.target import LoadCounts, Target, Token
from tidemark.plans.replay import fold_batches
from tidemark.session import workspace
from tidemark.sources import config, staged, tables
from tidemark.sources.late import Receipts, with_late

# Execution modes; INGEST is the older name of LOAD.
MODES = ["FULL", "EXPORT", "LOAD"]
# Event folders after which a run folds the ledger into a checkpoint.
CHECKPOINT_EVENTS = 256

RESULT_SCHEMA = T.StructType(
    [T.StructField("table_name", T.StringType()), T.StructField("status", T.StringType()),
     T.StructField("duration", T.LongType())]
    + [T.StructField(n, T.LongType()) for n in ("source_count", "target_count", "rows_extracted", "rows_rejected",
                                                "rows_inserted", "rows_updated", "rows_expired")]
    + [T.StructField("log", T.StringType())])


@dataclass
class Place:
    """Where a run reads from and writes to."""

    spark: SparkSession
    read: tables.Reader
    stage: str
    targets: str
    ledger: Ledger
    archive: str | None = None
    audit: str | None = None
    custom_tables: dict[str, DataFrame] = field(default_factory=dict)
    encryption_key: bytes | None = None
    count_source: bool = True  # off where a count would read the whole source, as over JDBC

    def target(self, job: dict) -> Target:
        return Target(self.spark, "/".join([self.targets, job.get("target_db") or "", job.get("target_schema") or "",
                                            job["target_table"]]))


class StepError(RuntimeError):
    def __init__(self, step: str, cause: Exception):
        super().__init__(f"{step}: {cause}")
        self.step = step


class _Run:
    """One job in one batch; what becomes known is written to the ledger as it happens."""

    def __init__(self, place: Place, job: dict, batch_id: int, now: datetime | None):
        self.place, self.job, self.batch_id = place, job, batch_id
        self.job_id = int(job.get("job_id") or job_ids(place.spark, [job])[0])
        self.start = now or datetime.now(timezone.utc).replace(tzinfo=None)
        self.clock = time.monotonic()
        self.known: dict = {}

    @property
    def token(self) -> str:
        """The name under which the target keeps the applied batches of this job's source."""
        return staged.source_name(self.job)

    def now(self) -> datetime:
        """The run's start moved on by the time passed: later batches get later versions."""
        return self.start + timedelta(seconds=time.monotonic() - self.clock)

    def note(self, **values) -> None:
        self.known.update(values)
        self.place.ledger.event(self.batch_id, self.job_id, time.time_ns() // 1000, **values)

    def step(self, name: str, work):
        try:
            return work()
        except Exception as error:
            raise StepError(name, error) from error


def _query(place: Place, job: dict) -> DataFrame:
    """A job's custom query over a window without rows: what its columns are."""
    return tables.run_query(place.spark, job["custom_sql"], place.custom_tables, FIRST_START, FIRST_START)


def _source_schema(place: Place, job: dict) -> T.StructType:
    rows = _query(place, job) if job.get("custom_sql") else place.read(job)
    if name_list(job.get("encryption_columns")):
        secret = {c.lower() for c in name_list(job["encryption_columns"])}
        rows = rows.select(*[F.col(c).cast("string").alias(c) if c.lower() in secret else F.col(c)
                             for c in rows.columns])
    return target_schema(column_metadata(rows), history=int(job.get("scd_type") or 0) == 2)


def ensure_target(place: Place, job: dict) -> Target:
    """The job's target, made from the source's columns if it is not there yet."""
    target = place.target(job)
    if target.exists():
        return target
    return target.create(_source_schema(place, job), name_list(job.get("primary_key")),
                         int(job.get("slices") or 1), job.get("partition_column"))


def _lookback(job: dict) -> timedelta:
    """How far before the last window a job looks for changes that were committed late; nothing unless its settings say so."""
    by_time = (job.get("load_type") or "full").lower() == "incremental" and (job.get("cdc_type") or "TIMESTAMP").upper() == "TIMESTAMP"
    if not by_time or job.get("custom_sql") or not name_list(job.get("cdc_columns")):
        return timedelta(0)
    return timedelta(seconds=int(job.get("lookback_seconds") or 0))


def _changed(run: _Run, mark: dict | None) -> DataFrame:
    """The rows that one run of a job with a lookback moves, and a receipt of them. They are written first, so that receipt and
    stage hold the same rows whatever the source does meanwhile."""
    place, job = run.place, run.job
    source, times = place.read(job), name_list(job["cdc_columns"])
    receipts = Receipts(place.spark, f"{place.targets}/_receipts/{staged.source_name(job)}")
    if mark and mark["window_end"]:
        exported = place.ledger.exported(job)
        since = receipts.since(exported, mark["window_end"], _lookback(job))
        rows = with_late(source, times, mark["window_end"], run.start, since, receipts.read(exported, since, source, times))
    else:
        rows = tables.select_rows(source, extract_condition(job, mark, run.start))
    folder = workspace(place.spark, f"export-{job['source_table']}")
    rows.write.parquet(folder)
    rows = place.spark.read.schema(rows.schema).parquet(folder)
    receipts.add(rows, times, run.batch_id)
    return tables.prepare(rows, job, place.encryption_key)


def _export(run: _Run) -> None:
    place, job = run.place, run.job
    target = place.target(job)
    if target.exists() and target.is_applied(run.token, run.batch_id):
        raise ValueError(f"batch {run.batch_id} of {run.token} is in the target already")
    mark = place.ledger.watermark(job)
    by_id = (job.get("cdc_type") or "TIMESTAMP").upper() == "ID" and name_list(job.get("cdc_columns"))
    if _lookback(job):
        rows = _changed(run, mark)
    else:
        rows = tables.extract(place.spark, job, place.read, mark, run.start, place.custom_tables, place.encryption_key)
    # the files of a query have numbered columns; what they are called is the query's to say
    named = _query(place, job) if job.get("custom_sql") else rows
    if target.exists():  # a source whose columns no longer fit is refused before anything is moved
        evolved(target.schema, target_schema(column_metadata(named)), name_list(job.get("primary_key")))
    folder = staged.batch_folder(place.stage, job, run.batch_id)
    wanted = by_id[0] if by_id and not job.get("custom_sql") else None
    n, top = staged.write_staged(rows, folder, job.get("delimiter"), highest=wanted, columns=named.schema)
    first = datetime.fromisoformat(FIRST_START)
    run.note(export_status=SUCCESS, upload_status=SUCCESS, export_path=folder, rows_extracted=n,
             window_start=(mark or {}).get("window_end") or first, window_end=run.start,
             max_id=top if top is not None else (mark or {}).get("max_id"))


def _work_rows(place: Place, job: dict, target: Target, batches: list[int], folder: str) -> tuple[DataFrame, staged.StageCounts]:
    """Staged batches as a typed work table with ``batch_id``; rejects are kept beside the target.

    The target takes on the columns that the batches bring. A load of which more than ``reject_share`` (1: all) of the rows do not
    fit fails, and its batches keep waiting.
    """
    folders = [staged.batch_folder(place.stage, job, b) for b in batches]
    whole = target.schema
    for said in filter(None, (staged.exported_schema(place.spark, f) for f in folders)):
        whole = evolved(whole, target_schema(column_metadata(place.spark.createDataFrame([], said))), name_list(job.get("primary_key")))
    target.evolve(whole)
    schema = T.StructType([f for f in whole if f.name.lower() not in HISTORY_COLUMNS])
    text = staged.read_by_name(place.spark, folders, schema, job.get("delimiter"),
                               base=staged.table_folder(place.stage, job))
    checked = staged.check_rows(text, schema).withColumn("batch_id", F.col("batch_id").cast("long"))
    work, bad, counts = staged.materialise(checked, schema, f"{folder}/work")
    if counts.rows_rejected:
        # A folder of the batches that are loaded together: a load that is run again writes it again.
        place_of = f"{staged.source_name(job)}/load={'-'.join(map(str, batches))}"
        bad.write.mode("overwrite").parquet(f"{target.root}/_rejects/{place_of}")
    share = float(job.get("reject_share") or 1.0)
    if counts.rows_rejected and (not counts.rows_loaded or counts.rows_rejected > share * counts.rows_read):
        raise ValueError(f"{counts.rows_rejected} of {counts.rows_read} rows were rejected")
    return work.drop("_file"), counts


def _ready(place: Place, job: dict, work: DataFrame, keys: list[str], kind: str, folder: str) -> DataFrame:
    """Work rows one per key. Loads that read them more than once get them written."""
    if not keys or kind == "append":
        return work.drop("batch_id")
    newest = [c for c in name_list(job.get("cdc_columns")) if c.lower() in [w.lower() for w in work.columns]]
    if kind == "scd1":
        rows = fold_batches(work, keys, "batch_id", newest)
    else:
        rows = dedup(work.drop("batch_id"), keys, newest)
    if kind not in ("scd1", "scd2"):
        return rows
    rows.write.parquet(folder)
    return place.spark.read.schema(rows.schema).parquet(folder)


def load_batches(place: Place, job: dict, target: Target, token: str, batches: list[int], now: Callable[[int], datetime],
                 step: Callable = lambda name, work: work()) -> tuple[str, LoadCounts, staged.StageCounts, list[int]]:
    """Apply staged batches in their order; ``now`` gives the time at which the versions of a batch start.

    Returns the load kind, both counts, and the batches that a later full one replaced.
    """
    kind = load_kind(job.get("load_type"), job.get("scd_type"))
    keys = name_list(job.get("primary_key"))
    allow = bool(job.get("allow_history_loss"))
    # An upsert takes the last batch of each key and a full replace the last batch, so their
    # batches go in together; history and filtered reloads depend on every batch in turn.
    replaced = batches[:-1] if kind == "full" else []
    if kind == "full":
        groups = [batches[-1:]]
    elif kind in ("scd1", "append"):
        groups = [batches]
    else:
        groups = [[b] for b in batches]
    total, read = LoadCounts(), staged.StageCounts(0, 0, 0)
    for group in groups:
        folder = workspace(place.spark, f"load-{job['target_table']}")
        work, counts = step("copy", lambda g=group, f=folder: _work_rows(place, job, target, g, f))
        read = staged.StageCounts(*[a + b for a, b in zip(read, counts)])

        def apply(rows=work, group=group, folder=folder):
            ready = _ready(place, job, rows, keys, kind, f"{folder}/unique")
            return target.load(ready, job.get("load_type"), job.get("scd_type"), keys, now(group[-1]),
                               job.get("filter_condition"), allow, Token(token, tuple([*replaced, *group])))
        total = LoadCounts(*[a + b for a, b in zip(total, step("merge", apply))])
        fs.remove(place.spark, folder)  # the rows are in the target now
    target.compact()  # appends add folders; the list of them stays bounded
    return kind, total, read, replaced


def _load(run: _Run, batches: list[int]) -> None:
    place, job = run.place, run.job
    keys = name_list(job.get("primary_key"))
    target = run.step("create_table", lambda: ensure_target(place, job))
    applied = target.applied(run.token)  # read once, however many batches wait
    waiting = [b for b in batches if any(low <= b <= high for low, high in applied)]
    batches = [b for b in batches if b not in waiting]
    if not batches:
        raise StepError("copy", ValueError("no files in the stage, nothing to load"))
    kind, total, read, replaced = load_batches(place, job, target, run.token, batches, lambda _: run.now(), run.step)
    log = f"{kind}: {total.rows_inserted} inserted, {total.rows_updated} updated, {total.rows_expired} expired"
    known = {"rows_extracted": read.rows_loaded} if "rows_extracted" not in run.known else {}
    run.known.update(
             create_table_status=SUCCESS, create_stage_status=SUCCESS, copy_status=SUCCESS,
             copy_log=f"{read.rows_loaded} rows loaded, {read.rows_rejected} rejected", merge_status=SUCCESS,
             merge_log=log, merge_statement=f"{kind} {target.root} by {', '.join(keys) or 'no key'}",
             rows_rejected=read.rows_rejected, rows_inserted=total.rows_inserted,
             rows_updated=total.rows_updated, rows_expired=total.rows_expired,
             target_count=target.count(), **known)
    others = [b for b in batches if b != run.batch_id]
    if others:
        paths = {staged.batch_folder(place.stage, job, b): b for b in others}
        by = place.ledger.exporters(list(paths))
        for b in others:
            at = time.time_ns() // 1000
            if b in replaced:
                place.ledger.event(b, by.get(b, run.job_id), at, ingestion_completed=SUPERSEDED, copy_status=SUPERSEDED,
                                   copy_log=f"superseded by batch {batches[-1]}", merge_status=SUPERSEDED)
            else:
                # Its run may have failed in a load step; its rows are in the target now.
                place.ledger.event(b, by.get(b, run.job_id), at, ingestion_completed="YES", copy_status=SUCCESS,
                                   merge_status=SUCCESS, final_status=SUCCESS)
    if place.archive:
        # After the commit, so a load that failed can be run again. The rows are loaded: what goes wrong here is noted.
        for b in [*waiting, *batches]:
            try:
                staged.archive(place.spark, place.stage, job, b, place.archive, run.start.strftime("%Y%m%d"))
            except Exception as error:
                run.known["copy_log"] += f"; batch {b} not archived: {error}"


def run_table(place: Place, job: dict, mode: str, batch_id: int, now: datetime | None = None) -> dict:
    """One job: FULL extracts and loads, EXPORT only extracts, LOAD applies all that waits."""
    mode = "LOAD" if mode.upper() == "INGEST" else mode.upper()
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    run = _Run(place, job, batch_id, now)
    status, log = SUCCESS, ""
    run.note(**{k: job.get(k) for k in ("source_db", "source_schema", "source_table", "target_db", "target_schema",
                                        "target_table", "custom_sql")},
             load_type=(job.get("load_type") or "full").upper(), stage_path=place.stage, execution_mode=mode,
             job_start_time=run.start, **{f"{s}_status": SKIPPED for s in
                                          {"EXPORT": LOAD_STEPS, "LOAD": EXTRACT_STEPS}.get(mode, [])})
    try:
        if mode in ("FULL", "EXPORT"):
            run.step("export", lambda: _export(run))
        if mode in ("FULL", "LOAD"):
            _load(run, staged.pending_batches(place.spark, place.stage, job))
        if place.count_source and not job.get("custom_sql"):
            run.known["source_count"] = place.read(job).count()
    except StepError as error:
        status, log = FAILED, str(error)
        run.known.update({f"{error.step}_status": FAILED, f"{error.step}_log": log})
    except Exception as error:  # whatever else ends a run, the ledger says so
        status, log = FAILED, str(error)
    duration = int(time.monotonic() - run.clock)
    written = {"source_db", "source_schema", "source_table", "target_db", "target_schema", "target_table", "custom_sql",
               "load_type", "stage_path", "execution_mode", "job_start_time"}
    run.note(**{k: v for k, v in run.known.items() if k not in written}, final_status=status, job_duration=duration,
             job_end_time=datetime.now(timezone.utc).replace(tzinfo=None),
             ingestion_completed="YES" if status == SUCCESS and mode != "EXPORT" else "NO",
             **({"audit_status": SUCCESS} if place.audit and status == SUCCESS else {}))
    if place.audit:
        place.ledger.write_audit(place.audit, batch_id, run.job_id)
    known = run.known
    return {"table_name": job["source_table"], "status": status, "duration": duration, "log": log,
            **{n: known.get(n) or 0 for n in ("source_count", "target_count", "rows_extracted", "rows_rejected",
                                              "rows_inserted", "rows_updated", "rows_expired")}}


def job_ids(spark: SparkSession, jobs: list[dict]) -> list[int]:
    """An id for each job that follows from its tables alone, whatever jobs run beside it."""
    names = ["source_db", "source_schema", "source_table", "target_table"]
    rows = [(i, *[job.get(n) for n in names]) for i, job in enumerate(jobs)]
    schema = "place int, " + ", ".join(f"{n} string" for n in names)
    found = config.with_job_ids(spark.createDataFrame(rows, schema)).orderBy("place").collect()  # one row per job
    return [r["job_id"] for r in found]


def run_many(place: Place, jobs: list[dict], mode: str | None = None, batch_id: int | None = None,
             at_once: int = 4, now: datetime | None = None) -> DataFrame:
    """Run jobs side by side in fair pools. One failure does not stop the others."""
    spark = place.spark
    batch_id = place.ledger.next_batch_id() if batch_id is None else batch_id
    ids = job_ids(spark, jobs)

    def one(numbered: tuple[int, dict]) -> dict:
        job_id, job = numbered
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", job["source_table"])
        try:
            return run_table(place, {"job_id": job_id, **job}, mode or job.get("execution_mode") or "FULL", batch_id, now)
        except Exception as error:
            return {"table_name": job["source_table"], "status": FAILED, "duration": 0, "log": str(error),
                    **{f.name: 0 for f in RESULT_SCHEMA if isinstance(f.dataType, T.LongType)}}

    with ThreadPoolExecutor(at_once) as threads:
        results = list(threads.map(inheritable_thread_target(spark)(one), zip(ids, jobs)))
    place.ledger.checkpoint(CHECKPOINT_EVENTS)
    return spark.createDataFrame([tuple(r[f.name] for f in RESULT_SCHEMA) for r in results],
                                 RESULT_SCHEMA).orderBy("table_name")


def run_config(place: Place, settings: DataFrame, mode: str | None = None, at_once: int = 4,
               now: datetime | None = None, **only: str | None) -> DataFrame:
    """All enabled jobs of a settings table, or one table's (``source_db``, ``source_schema``,
    ``source_table``), in one batch."""
    enabled = config.with_job_ids(config.enabled_jobs(config.normalise(settings), None, mode, **only))
    # One small row per table to replicate.
    jobs = [row.asDict() for row in enabled.orderBy("source_db", "source_schema", "source_table").collect()]
    return run_many(place, jobs, mode, None, at_once, now)
