"""Replaying many staged batches onto a target in batch order.

For upserts the last batch of a key wins, so all batches fold into one load. For history
every batch can make a version, but versions follow from comparing a key's neighbouring
batches, so all of them are found in one pass too, without a load per batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.types import HISTORY_COLUMNS, resolve, split_keys
from tidemark.operators.dedup import dedup
from tidemark.operators.merge import align, scd1


def fold_batches(batches: DataFrame, keys: list[str], batch: str = "batch_id",
                 newest: list[str] | None = None) -> DataFrame:
    """The last row of each key over all batches."""
    return dedup(batches, keys, [batch, *(newest or [])]).drop(batch)


def replay_scd1(target: DataFrame, batches: DataFrame, keys: list[str], batch: str = "batch_id",
                newest: list[str] | None = None) -> DataFrame:
    return scd1(target, fold_batches(batches, keys, batch, newest), keys)


def _as_compared(rows: DataFrame, values: list[str]) -> Column:
    """The values of a row as they count for a change: NULL text equals empty text."""
    parts = []
    for name in values:
        text = isinstance(rows.schema[name].dataType, (T.StringType, T.BinaryType))
        parts.append((F.coalesce(F.col(name).cast("string"), F.lit("")) if text else F.col(name)).alias(name))
    return F.struct(*parts) if parts else F.struct(F.lit(0).alias("none"))


def replay_scd2(target: DataFrame, batches: DataFrame, keys: list[str], batch_times: dict[int, str],
                batch: str = "batch_id", newest: list[str] | None = None) -> DataFrame:
    """The history target after all batches, as if they had been loaded one after the other.

    ``batch_times`` gives the run time of every batch. The target may hold at most one
    current row per key, as history loads leave it. After the first de-duplication a key has
    at most one row per batch, which bounds every window below by the number of batches.
    """
    keys, values = split_keys(target.columns, keys)
    batch = resolve([batch], batches.columns)[0]
    one = dedup(batches, [batch, *keys], newest)
    work = align(one, target).columns
    staged = one.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in work], batch)
    # A few literals, so looked up in the row; a join would gather each batch in one task.
    kind = staged.schema[batch].dataType
    times = F.create_map(*[c for n, at in batch_times.items() for c in (F.lit(n).cast(kind), F.lit(str(at)))])
    staged = staged.withColumn("_start", times[F.col(batch)].cast("timestamp_ntz"))

    is_current = F.coalesce("is_current", F.lit(False))
    before = target.where(is_current).select(
        *work, F.lit(None).cast(staged.schema[batch].dataType).alias(batch), F.col("eff_start_date").alias("_start"))
    rows = before.unionByName(staged)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()

    # A NULL key matches nothing: each such row is a version of its own that nothing closes.
    lone = rows.where(null_key).select(
        *work, F.lit(True).alias("is_current"), F.col("_start").alias("eff_start_date"),
        F.lit(None).cast("timestamp_ntz").alias("eff_end_date"))

    by_key = Window.partitionBy(*keys).orderBy(F.col(batch).asc_nulls_first())
    seen = rows.where(~null_key).withColumn("_now", _as_compared(rows, values))
    changed = seen.withColumns({
        "_nth": F.row_number().over(by_key),
        "_before": F.lag("_now").over(by_key),
    }).where((F.col("_nth") == 1) | ~F.col("_now").eqNullSafe(F.col("_before")))
    versions = changed.withColumn("_end", F.lead("_start").over(by_key)).select(
        *work, F.col("_end").isNull().alias("is_current"), F.col("_start").alias("eff_start_date"),
        F.col("_end").alias("eff_end_date"))

    closed = target.where(~is_current)
    ordered = [c for c in target.columns if c.lower() in HISTORY_COLUMNS or c in work]
    return closed.select(*ordered).unionByName(versions.select(*ordered)).unionByName(lone.select(*ordered))
