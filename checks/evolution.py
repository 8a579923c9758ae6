"""Sources whose columns change, streams of finished batches, comparison by content, splits of a read."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.common import check, table
from checks.jobs import _BATCHED, _BATCHES, _KEYS, _LINE, _STREAMED, _batched, _settings
from tidemark.functions.types import ColumnMeta, target_schema
from tidemark.operators.dedup import dedup
from tidemark.operators.ledger import Ledger
from tidemark.plans import job as jobs, reconcile
from tidemark.session import workspace
from tidemark.sources import staged, tables
from tidemark.streaming.staged_stream import apply_finished

_CUT = "1997-01-01"


def _place(spark, sources: list):
    """A place whose source is the next of some tables with each export."""
    root = workspace(spark, "run")
    return jobs.Place(spark, lambda job: sources[0], f"{root}/stage", f"{root}/targets", Ledger(spark, f"{root}/ledger"))


def _exported(place, sources, settings) -> None:
    """One export of each source table in turn."""
    for n in range(len(sources)):
        done = jobs.run_table(place, settings, "EXPORT", 10000 + n, datetime(2030, 1, 1 + n))
        assert done["status"] == "SUCCESS", done
        if len(sources) > 1:
            sources.pop(0)


@check("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def column_order_change(spark, sf):
    """A source whose columns come in another order: every value stays in its column."""
    orders = table(spark, sf, "orders")
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    sources = [orders.where(F.col("o_orderdate") < _CUT).select(*names), orders.select(*reversed(names))]
    place, settings = _place(spark, sources), _settings("orders", "incremental", 1, "o_orderkey")
    _exported(place, sources, settings)
    assert jobs.run_table(place, settings, "LOAD", 10009, datetime(2031, 1, 1))["status"] == "SUCCESS"
    return place.target(settings).read()


@check(f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= DATE '{_CUT}' THEN o_totalprice END AS o_totalprice FROM orders""")
def column_added(spark, sf):
    """A source that gains a column: old rows have NULL there, new rows their value, none is rejected."""
    orders = table(spark, sf, "orders")
    sources = [orders.where(F.col("o_orderdate") < _CUT).select("o_orderkey", "o_custkey"),
               orders.where(F.col("o_orderdate") >= _CUT).select("o_totalprice", "o_orderkey", "o_custkey")]
    place, settings = _place(spark, sources), _settings("orders", "incremental", 1, "o_orderkey")
    for n in range(2):
        done = jobs.run_table(place, settings, "FULL", 10000 + n, datetime(2030, 1, 1 + n))
        assert done["status"] == "SUCCESS" and not done["rows_rejected"], done
        sources[:] = sources[-1:]
    return place.target(settings).read()


@check("""SELECT 'FAILED' AS status, count(*) AS exported, CAST(0 AS BIGINT) AS in_target, CAST(1 AS BIGINT) AS waiting FROM orders""")
def all_rejected_fails(spark, sf):
    """A load of which no row fits the target fails, and its batch keeps waiting."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    place, settings = _place(spark, [orders]), _settings("orders", "incremental", 1, "o_orderkey")
    narrow = target_schema([ColumnMeta("o_orderkey", "bigint"), ColumnMeta("o_orderpriority", "varchar", 1)])
    target = place.target(settings).create(narrow, ["o_orderkey"])
    done = jobs.run_table(place, settings, "FULL", 10000, datetime(2030, 1, 1))
    rows = target.read().agg(F.count("*").alias("in_target"))
    return rows.select(F.lit(done["status"]).alias("status"), F.lit(done["rows_extracted"]).cast("long").alias("exported"), "in_target",
                       F.lit(len(staged.pending_batches(spark, place.stage, settings))).cast("long").alias("waiting"))


def _staged_lines(spark, sf, scd: int):
    lines = table(spark, sf, "lineitem").select(*_LINE, "l_shipdate")
    settings = _settings("lineitem", "incremental", scd, ", ".join(_KEYS), cdc_columns="l_shipdate")
    place = _place(spark, [lines])
    batches = _batched(spark, sf)

    def export(n):
        batch = batches.where(F.col("batch_id") == n).drop("batch_id")
        rows = dedup(batch, _KEYS, ["l_shipdate"])
        staged.write_staged(rows.select(*lines.columns), staged.batch_folder(place.stage, settings, n), like=batch.select(*lines.columns))

    def stream(checkpoint):
        starts = {n: datetime.fromisoformat(at) for n, _, _, at in _BATCHES}
        (apply_finished(place, settings, patience=5, run_at=starts.__getitem__).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())

    return place, settings, export, stream


@check(f"""WITH {_BATCHED} SELECT {', '.join(_LINE)} FROM batched WHERE batch_id IN (1, 3)
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY batch_id DESC) = 1""")
def stream_skips_dead_exports(spark, sf):
    """An export that died has no marker: its files are never read, and later batches that have waited enough are."""
    place, settings, export, _ = _staged_lines(spark, sf, 1)
    for n in (1, 2, 3):
        export(n)
    dead = staged.batch_folder(place.stage, settings, 2)
    from tidemark import fs
    fs.remove(spark, f"{dead}/_SUCCESS")
    (apply_finished(place, settings, run_at=lambda b: datetime(2024, b, 1)).option("checkpointLocation", workspace(spark, "checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    return place.target(settings).read().select(*_LINE)


@check(_STREAMED)
def stream_waits_for_late_batch(spark, sf):
    """Batch 3 of a history target is there before batch 2, and waits for it."""
    place, settings, export, stream = _staged_lines(spark, sf, 2)
    checkpoint = workspace(spark, "checkpoint")
    export(1)
    export(3)
    stream(checkpoint)
    assert place.target(settings).applied(staged.source_name(settings)) == [[1, 1]]
    export(2)
    stream(checkpoint)
    return place.target(settings).read().select(*_LINE, "is_current", "eff_start_date", "eff_end_date")


@check("""WITH a AS (SELECT * FROM lineitem), d AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM a GROUP BY ALL),
  k AS (SELECT l_orderkey, l_linenumber,
    bool_or(l_shipdate < TIMESTAMP '1993-01-01') AS early, bool_and(l_shipdate < TIMESTAMP '1993-01-01') AS gone,
    bool_or(l_returnflag = 'R' AND l_quantity >= 49 AND l_shipdate >= TIMESTAMP '1993-01-01') AS changed FROM a GROUP BY ALL)
  SELECT l_orderkey, l_linenumber, CASE WHEN gone THEN 'lost' ELSE 'changed' END AS difference FROM k WHERE early OR changed
  UNION ALL SELECT -1 - l_orderkey, l_linenumber, 'added' FROM k""")
def reconcile_rows(spark, sf):
    """Between two versions of the line items: exactly the keys that were changed, lost and added."""
    old = table(spark, sf, "lineitem")
    kept = old.where(F.col("l_shipdate") >= "1993-01-01").withColumn(
        "l_quantity", F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 49), F.col("l_quantity") + 1)
        .otherwise(F.col("l_quantity")))
    added = old.select(*_KEYS).distinct().select((-1 - F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber")
    new = kept.unionByName(added, allowMissingColumns=True)
    return reconcile.reconcile_rows(old, new, _KEYS)


@check("SELECT CAST(32 AS INT) AS splits, count(*) AS n_rows, true AS balanced FROM lineitem")
def split_bounds(spark, sf):
    """A skewed column cut by a quantile sketch: every row is in one split, and none holds more than twice the mean."""
    rows = table(spark, sf, "lineitem").withColumn("skewed", F.pow(F.col("l_orderkey") + 1, F.lit(4)))
    bounds = tables.split_bounds(rows, "skewed", 32)
    split = F.lit(0)
    for n, condition in enumerate(tables.split_conditions("skewed", bounds)):
        split = split + F.when(F.expr(condition), n + 1).otherwise(0)
    counts = rows.groupBy(split.alias("split")).agg(F.count("*").alias("n"))
    return counts.agg(F.count("*").cast("int").alias("splits"), F.sum("n").alias("n_rows"),
                      ((F.max("n") <= 2 * F.avg("n")) & (F.min("split") == 1)).alias("balanced"))


@check()
def discover_minimal_keys(spark, sf):
    """Every minimal key of up to three columns, of all fourteen tables."""
    from checks.common import TABLES
    from tidemark.sources.discover import profile_minimal_keys
    return profile_minimal_keys(spark, {name: table(spark, sf, name) for name in TABLES}, width=3)
