"""Whole jobs: runs, replay of staged batches, the stream."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.common import check, table
from checks.history import scd2_sql
from tidemark.functions.types import column_metadata, target_schema, with_history
from tidemark.operators.ledger import Ledger
from tidemark.operators.target import Target
from tidemark.plans import job as jobs, replay
from tidemark.session import workspace
from tidemark.sources import staged
from tidemark.sources.tables import parquet_reader
from tidemark.streaming.staged_stream import apply_stream, read_stream

# Line items as three batches of changes to (order, line), cut by ship date.
_BATCHES = [(1, "1900-01-01", "1997-06-01", "2024-01-01 00:00:00"),
            (2, "1997-06-01", "1999-06-01", "2024-02-01 00:00:00"),
            (3, "1999-06-01", "2100-01-01", "2024-03-01 00:00:00")]
_KEYS = ["l_orderkey", "l_linenumber"]
_LINE = [*_KEYS, "l_returnflag", "l_linestatus"]
_ORDER = """ORDER BY {first}l_shipdate DESC NULLS LAST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
  l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
  l_returnflag NULLS FIRST, l_linestatus NULLS FIRST"""
_CUT = " ".join(f"WHEN l_shipdate < TIMESTAMP '{end}' THEN {n}" for n, _, end, _ in _BATCHES)
_BATCHED = f"""batched AS (SELECT * FROM (SELECT *, CASE {_CUT} END AS batch_id FROM lineitem)
  QUALIFY row_number() OVER (PARTITION BY batch_id, l_orderkey, l_linenumber {_ORDER.format(first='')}) = 1)"""


def _batched(spark, sf):
    cut = None
    for n, _, end, _ in _BATCHES:
        hit = F.col("l_shipdate") < F.lit(end).cast("timestamp_ntz")
        cut = F.when(hit, n) if cut is None else cut.when(hit, n)
    return table(spark, sf, "lineitem").withColumn("batch_id", cut)


@check(f"""WITH {_BATCHED} SELECT {', '.join(_LINE)} FROM batched
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber {_ORDER.format(first='batch_id DESC, ')}) = 1""")
def replay_backlog_scd1(spark, sf):
    """Many batches folded into one upsert."""
    batches = _batched(spark, sf)
    first = batches.where("batch_id = 1").select(*_LINE).dropDuplicates(_KEYS)
    return replay.replay_scd1(first, batches, _KEYS, newest=["l_shipdate"])


def _one(n: int) -> str:
    return f"b{n} AS (SELECT {', '.join(_LINE)} FROM batched WHERE batch_id = {n})"


_REPLAYED = f"""WITH {_BATCHED}, {_one(1)}, {_one(2)}, {_one(3)},
  r1 AS (SELECT *, true AS is_current, TIMESTAMP '{_BATCHES[0][3]}' AS eff_start_date,
    CAST(NULL AS TIMESTAMP) AS eff_end_date FROM b1),
  {scd2_sql('r1', 'b2', _KEYS, _LINE, _BATCHES[1][3], name='r2')},
  {scd2_sql('r2', 'b3', _KEYS, _LINE, _BATCHES[2][3], name='r3')} SELECT * FROM r3"""


@check(_REPLAYED)
def replay_backlog_scd2(spark, sf):
    """Every batch makes versions; all are found in one pass."""
    batches = _batched(spark, sf)
    times = {n: at for n, _, _, at in _BATCHES}
    empty = with_history(batches.select(*_LINE), _BATCHES[0][3]).limit(0)
    return replay.replay_scd2(empty, batches, _KEYS, times, newest=["l_shipdate"])


@check(_REPLAYED)
def replay_batches_into_target(spark, sf):
    """The same batches loaded one after the other into a written target."""
    batches = _batched(spark, sf)
    from tidemark.operators.dedup import dedup
    schema = with_history(batches.select(*_LINE), _BATCHES[0][3]).schema
    target = Target(spark, workspace(spark, "lines")).create(schema, _KEYS, 4)
    for n, _, _, at in _BATCHES:
        folder = workspace(spark, f"batch-{n}")
        rows = batches.where(F.col("batch_id") == n).drop("batch_id")
        dedup(rows, _KEYS, ["l_shipdate"]).select(*_LINE).write.parquet(folder)
        target.track(spark.read.parquet(folder), at)
    return target.read()


@check("""SELECT user_id, event_type, event_id, ts, value FROM events QUALIFY row_number() OVER (
            PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id NULLS FIRST, value NULLS FIRST) = 1""")
def stream_apply_scd1(spark, sf):
    """Events staged in three parts, each taken up by a stream and upserted."""
    columns = ["user_id", "event_type", "event_id", "ts", "value"]
    events = table(spark, sf, "events").select(*columns)
    stage, checkpoint = workspace(spark, "stage"), workspace(spark, "checkpoint")
    schema = target_schema(column_metadata(events))
    target = Target(spark, workspace(spark, "events")).create(schema, ["user_id", "event_type"])
    for n, (low, high) in enumerate((("2000-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"),
                                     ("2024-01-21", "2100-01-01"))):
        part = events.where(f"ts >= timestamp_ntz'{low}' and ts < timestamp_ntz'{high}'")
        staged.write_staged(part, f"{stage}/batch_id={n}")
        query = (apply_stream(read_stream(spark, stage, schema), target, ["user_id", "event_type"], "incremental", 1,
                              ["ts"]).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    return target.read()


def _settings(name, load="full", scd=0, key=None, **more):
    return {"source_db": "sales", "source_schema": "dbo", "source_table": name, "target_db": "ANALYTICS",
            "target_schema": "PUBLIC", "target_table": name.upper(), "load_type": load, "scd_type": scd,
            "primary_key": key, "cdc_type": "TIMESTAMP", "delimiter": "|", **more}


@check("""SELECT 'customer' AS table_name, 'SUCCESS' AS status, count(*) AS source_count, count(*) AS target_count,
            count(*) AS rows_extracted, count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_rejected FROM customer
          UNION ALL SELECT 'orders', 'SUCCESS', count(*), count(*) FILTER (WHERE o_orderstatus = 'F'),
            count(*) FILTER (WHERE o_orderstatus = 'F'), count(*) FILTER (WHERE o_orderstatus = 'F'), 0 FROM orders
          UNION ALL SELECT 'lineitem', 'SUCCESS', count(*), count(DISTINCT (l_orderkey, l_linenumber)), count(*),
            count(DISTINCT (l_orderkey, l_linenumber)), 0 FROM lineitem
          UNION ALL SELECT 'missing', 'FAILED', 0, 0, 0, 0, 0""")
def multi_table_run(spark, sf):
    """Four jobs side by side, one of which fails."""
    root = workspace(spark, "run")
    place = jobs.Place(spark, parquet_reader(spark, sf), f"{root}/stage", f"{root}/targets",
                       Ledger(spark, f"{root}/ledger"), archive=f"{root}/archive")
    rows = jobs.run_many(place, [
        _settings("customer", "incremental", 2, "c_custkey"),
        _settings("orders", "filter", 0, "o_orderkey", filter_condition="o_orderstatus = 'F'"),
        _settings("lineitem", "incremental", 1, "l_orderkey, l_linenumber", cdc_columns="l_shipdate"),
        _settings("missing")])
    return rows.select("table_name", "status", "source_count", "target_count", "rows_extracted", "rows_inserted",
                       "rows_rejected")


def _place(spark, sf):
    root = workspace(spark, "run")
    return jobs.Place(spark, parquet_reader(spark, sf), f"{root}/stage", f"{root}/targets", Ledger(spark, f"{root}/ledger"),
                      archive=f"{root}/archive")


@check("SELECT * FROM orders")
def late_batch_load(spark, sf):
    """An export with a lower batch id than one that is loaded already still reaches the target."""
    place = _place(spark, sf)
    settings = _settings("orders", "incremental", 1, "o_orderkey", cdc_columns="o_orderdate")
    for batch, mode, now in ((10002, "FULL", datetime(1998, 1, 1)), (10001, "EXPORT", datetime(2030, 1, 1)),
                             (10003, "LOAD", datetime(2030, 1, 2))):
        done = jobs.run_table(place, settings, mode, batch, now)
        assert done["status"] == "SUCCESS", done
    return place.target(settings).read()


@check("SELECT *, 'SUCCESS FAILED SUCCESS FAILED SUCCESS' AS runs FROM orders")
def rerun_batch(spark, sf):
    """A batch id that has an export, waiting or loaded, is refused; no staged row is lost."""
    place = _place(spark, sf)
    settings = _settings("orders", "incremental", 1, "o_orderkey", cdc_columns="o_orderdate")
    runs = []
    for batch, mode, now in ((10000, "EXPORT", datetime(1998, 1, 1)), (10000, "EXPORT", datetime(1999, 1, 1)),
                             (10001, "LOAD", datetime(1999, 1, 2)), (10000, "FULL", datetime(2000, 1, 1)),
                             (10002, "FULL", datetime(2030, 1, 1))):
        runs.append(jobs.run_table(place, settings, mode, batch, now)["status"])
    return place.target(settings).read().withColumn("runs", F.lit(" ".join(runs)))


@check("""WITH t AS (SELECT 'customer' AS source_table, count(*) AS n, count(*) AS k FROM customer
            UNION ALL SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem)
          SELECT CAST(10000 AS BIGINT) AS batch_id, source_table, 'EXPORT' AS execution_mode, 'SUCCESS' AS final_status,
            CASE source_table WHEN 'customer' THEN 'SUPERSEDED' ELSE 'YES' END AS ingestion_completed,
            n AS rows_extracted, CAST(NULL AS BIGINT) AS rows_inserted FROM t
          UNION ALL SELECT 10001, source_table, 'EXPORT', 'SUCCESS', 'YES', n, NULL FROM t WHERE source_table = 'customer'
          UNION ALL SELECT 10002, source_table, 'LOAD', 'SUCCESS', 'YES', n, k FROM t""")
def ledger_of_a_run(spark, sf):
    """The ledger that exports and a load write: counts and marks of each table."""
    place = _place(spark, sf)
    both = [_settings("customer"), _settings("lineitem", "incremental", 1, "l_orderkey, l_linenumber", cdc_columns="l_shipdate")]
    jobs.run_many(place, both, "EXPORT", 10000, now=datetime(2030, 1, 1))
    jobs.run_many(place, both[:1], "EXPORT", 10001, now=datetime(2030, 1, 2))
    jobs.run_many(place, both, "LOAD", 10002, now=datetime(2030, 1, 3))
    return place.ledger.state().select("batch_id", "source_table", "execution_mode", "final_status", "ingestion_completed",
                                       "rows_extracted", "rows_inserted")


def _streamed(spark, sf, target, scd, run_at, files_per_trigger):
    """Three batches of line items, all of them staged before the stream starts."""
    batches, stage = _batched(spark, sf), workspace(spark, "stage")
    schema = target_schema(column_metadata(batches.select(*_LINE, "l_shipdate")))
    from tidemark.operators.dedup import dedup
    for n, *_ in _BATCHES:
        rows = dedup(batches.where(F.col("batch_id") == n).drop("batch_id"), _KEYS, ["l_shipdate"])
        staged.write_staged(rows.select(*schema.names), f"{stage}/batch_id={n}", files=1)
    text = read_stream(spark, stage, schema, files_per_trigger=files_per_trigger)
    (apply_stream(text, target, _KEYS, "incremental", scd, ["l_shipdate"], run_at=run_at)
     .option("checkpointLocation", workspace(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination())
    return target.read().select(*[c for c in target.schema.names if c != "l_shipdate"])


@check(f"""WITH {_BATCHED} SELECT {', '.join(_LINE)} FROM batched
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY batch_id DESC) = 1""")
def stream_orders_its_batches(spark, sf):
    """Three exports in one trigger: the last batch of a key wins."""
    lines = table(spark, sf, "lineitem").select(*_LINE, "l_shipdate")
    target = Target(spark, workspace(spark, "lines")).create(target_schema(column_metadata(lines)), _KEYS)
    return _streamed(spark, sf, target, 1, lambda b: datetime(2024, b, 1), 1000)


_STREAMED = f"""WITH {_BATCHED}, s AS (SELECT *, CAST(NULL AS TIMESTAMP) AS none FROM batched),
  v AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, batch_id, lead(batch_id) OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY batch_id) AS next FROM s)
  SELECT {', '.join(_LINE)}, next IS NULL AS is_current, make_timestamp(2024, batch_id, 1, 0, 0, 0) AS eff_start_date,
    CASE WHEN next IS NOT NULL THEN make_timestamp(2024, next, 1, 0, 0, 0) END AS eff_end_date FROM v"""


@check(_STREAMED)
def stream_apply_scd2(spark, sf):
    """Three exports in one trigger make all their versions; ship dates differ between batches, so each is one."""
    lines = table(spark, sf, "lineitem").select(*_LINE, "l_shipdate")
    target = Target(spark, workspace(spark, "lines")).create(target_schema(column_metadata(lines), history=True), _KEYS)
    return _streamed(spark, sf, target, 2, lambda b: datetime(2024, b, 1), 1000)


@check(_STREAMED)
def stream_apply_scd2_by_file(spark, sf):
    """The same with one file a trigger."""
    lines = table(spark, sf, "lineitem").select(*_LINE, "l_shipdate")
    target = Target(spark, workspace(spark, "lines")).create(target_schema(column_metadata(lines), history=True), _KEYS)
    return _streamed(spark, sf, target, 2, lambda b: datetime(2024, b, 1), 1)


@check("SELECT * FROM orders")
def export_then_load(spark, sf):
    """Exports that wait in the stage are applied in batch order by a later load."""
    root = workspace(spark, "run")
    place = jobs.Place(spark, parquet_reader(spark, sf), f"{root}/stage", f"{root}/targets",
                       Ledger(spark, f"{root}/ledger"), archive=f"{root}/archive")
    settings = _settings("orders", "incremental", 1, "o_orderkey", cdc_columns="o_orderdate")
    # Windows that end in 1998 and 2030: the second export holds the rest of the orders.
    for batch, now in ((10000, datetime(1998, 1, 1)), (10001, datetime(2030, 1, 1))):
        done = jobs.run_table(place, settings, "EXPORT", batch, now)
        assert done["status"] == "SUCCESS", done
    done = jobs.run_table(place, settings, "LOAD", 10002, datetime(2030, 1, 2))
    assert done["status"] == "SUCCESS", done
    return place.target(settings).read()


_LATE = "o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '1998-06-01' AND o_orderdate < TIMESTAMP '1998-09-01'"


@check(f"""SELECT o_orderkey, o_totalprice, o_orderdate,
            CASE WHEN o_orderdate >= TIMESTAMP '1999-03-01' THEN 3 WHEN o_orderdate >= TIMESTAMP '1998-09-01' OR ({_LATE}) THEN 2
              ELSE 1 END AS run FROM orders WHERE o_orderdate < TIMESTAMP '1999-06-01'""")
def cdc_late_commit(spark, sf):
    """Three appending runs. Some orders of one summer are committed after the first; each row is moved once, by the first run that can see it."""
    root = workspace(spark, "run")
    orders = parquet_reader(spark, sf)({"source_table": "orders"})
    seen = [orders.where(f"NOT ({_LATE})".replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))]
    place = jobs.Place(spark, lambda job: seen[0], f"{root}/stage", f"{root}/targets", Ledger(spark, f"{root}/ledger"))
    settings = _settings("orders", "incremental", 0, "o_orderkey", cdc_columns="o_orderdate", job_id=1,
                         lookback_seconds=120 * 86400)
    parts = []
    for run, day in enumerate(["1998-09-01", "1999-03-01", "1999-06-01"], 1):
        jobs.run_table(place, settings, "EXPORT", run, datetime.fromisoformat(day))
        seen[0] = orders
        rows = staged.read_text(spark, staged.batch_folder(place.stage, settings, run), orders.schema, "|")
        parts.append(staged.good_rows(staged.check_rows(rows, orders.schema), orders.schema).select(
            "o_orderkey", "o_totalprice", "o_orderdate", F.lit(run).alias("run")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
