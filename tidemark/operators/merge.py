"""Load operators: what a target holds after a batch is applied.

Each function takes the target and the work rows as DataFrames and returns the new
target. NULL keys match nothing, so rows with a NULL key are always inserted. Except for
appends, work rows are expected to be unique by key (see ``dedup``).

``small_work`` says that the work rows were measured and fit in every executor. The target is then
never shuffled, whatever its keys. Without it an upsert is one full join by key: work rows have one row per
key, and so have targets that loads have made. (Rows that a target was seeded with under one key meet in one task of that
join.) History loads use left joins, in which adaptive execution splits keys that hold many target rows. Rows with a NULL
in their key are spread over all tasks.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.predicates import all_of, row_differs
from tidemark.functions.types import data_columns, has_history, resolve, split_keys

BROADCAST_BYTES = 64 * 1024 * 1024
_SRC = "_src_"


class HistoryLossError(ValueError):
    """A load that would drop or overwrite the history columns of a target."""


class HistoryParts(NamedTuple):
    """The three parts of a history target after a batch."""

    history: DataFrame
    flagged: DataFrame
    inserted: DataFrame


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of a row's size in memory."""
    fixed, sized = 16, F.lit(0).cast("long")
    for field in df.schema:
        kind = field.dataType
        if isinstance(kind, T.VariantType):
            sized = sized + F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0))
        elif isinstance(kind, (T.StringType, T.BinaryType)):
            sized = sized + F.coalesce(F.octet_length(field.name), F.lit(0))
        fixed += 24
    return sized + F.lit(fixed)


def _sized(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _spread(df: DataFrame, keys: list[str], sign: int) -> Column:
    """0 for a row with a whole key; else one of many numbers. Joined on beside the key, it keeps rows with a NULL key,
    which match nothing, from meeting in one task. The two sides of a join take different signs."""
    whole = all_of([F.col(k).isNotNull() for k in keys])
    sortable = [f.name for f in df.schema if not isinstance(f.dataType, (T.VariantType, T.MapType))]
    return F.when(whole, F.lit(0)).otherwise(sign * (F.pmod(F.xxhash64(*sortable), F.lit(1009)) + 1)).cast("int")


def _as_source(work: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Work rows with prefixed names, ready to be joined to the target."""
    return work.select(*[F.col(c).alias(_SRC + c) for c in columns], F.lit(True).alias("_hit"),
                       _spread(work, keys, -1).alias(_SRC + "_spread"))


def _on(keys: list[str]) -> Column:
    return all_of([F.col(k) == F.col(_SRC + k) for k in [*keys, "_spread"]])


def _as_target(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.withColumn("_spread", _spread(rows, keys, 1))


def anti_join(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among the found ones.

    Rows with a NULL in their key match nothing. They go around the join, in which all of
    them would meet in one task.
    """
    whole = all_of([F.col(k).isNotNull() for k in keys])
    rest = rows.where(whole).join(found, keys, "left_anti").select(*rows.columns)
    return rest.unionByName(rows.where(~whole))


def matched_keys(target: DataFrame, work: DataFrame, keys: list[str], small_work: bool) -> DataFrame:
    """The distinct target keys that can match a work row."""
    found = target.select(*keys).dropna()
    if small_work:
        found = found.join(F.broadcast(work.select(*keys)), keys, "left_semi")
    return found.distinct()


def align(work: DataFrame, target: DataFrame) -> DataFrame:
    """Work rows in the target's data columns, order and types."""
    columns = data_columns(target.columns)
    names = resolve(columns, work.columns)
    return work.select(*[F.col(n).cast(target.schema[c].dataType).alias(c) for c, n in zip(columns, names)])


def _refuse_history(target: DataFrame, allow: bool, what: str) -> None:
    if has_history(target.columns) and not allow:
        raise HistoryLossError(f"{what} would lose the history of this target; pass allow_history_loss")


def new_versions(rows: DataFrame, run_ts) -> DataFrame:
    """Rows as current versions that start at ``run_ts``."""
    return rows.withColumns({
        "is_current": F.lit(True),
        "eff_start_date": F.lit(run_ts).cast("timestamp_ntz"),
        "eff_end_date": F.lit(None).cast("timestamp_ntz"),
    })


def append(target: DataFrame, work: DataFrame, allow_history_loss: bool = False) -> DataFrame:
    """SCD0: add all work rows, duplicates included."""
    _refuse_history(target, allow_history_loss, "an append")
    return target.unionByName(align(work, target), allowMissingColumns=True)


def full_replace(target: DataFrame, work: DataFrame, allow_history_loss: bool = False) -> DataFrame:
    """The work rows take the place of everything."""
    _refuse_history(target, allow_history_loss, "a full replace")
    return target.limit(0).unionByName(align(work, target), allowMissingColumns=True)


def filter_reload(target: DataFrame, work: DataFrame, condition: str | None,
                  allow_history_loss: bool = False) -> DataFrame:
    """Drop target rows where the condition is true, then add all work rows.

    A row on which the condition is NULL stays. An empty condition drops everything.
    """
    _refuse_history(target, allow_history_loss, "a filtered reload")
    drop = F.coalesce(F.expr(condition), F.lit(False)) if condition else F.lit(True)
    return target.where(~drop).unionByName(align(work, target), allowMissingColumns=True)


def upserted(target: DataFrame, work: DataFrame, keys: list[str], small_work: bool = False) -> DataFrame:
    """Target rows with the non-key columns of their work row, plus the mark ``_hit``."""
    keys, values = split_keys(target.columns, keys)
    source = _as_source(align(work, target), keys + values, keys)
    joined = _as_target(target, keys).join(_sized(source, small_work), _on(keys), "left")
    return joined.select(
        *[F.when(F.col("_hit"), F.col(_SRC + c)).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
          for c in target.columns],
        F.coalesce("_hit", F.lit(False)).alias("_hit"))


def unmatched(target: DataFrame, work: DataFrame, keys: list[str], small_work: bool = False) -> DataFrame:
    """Work rows whose key is not in the target."""
    keys, _ = split_keys(target.columns, keys)
    work = align(work, target)
    return anti_join(work, matched_keys(target, work, keys, small_work), keys)


def scd1(target: DataFrame, work: DataFrame, keys: list[str], small_work: bool = False,
         allow_history_loss: bool = False) -> DataFrame:
    """SCD1: overwrite matched rows, insert the others. Nothing is deleted.

    History columns of the target, if any, are left as they are.
    """
    if not keys:
        raise ValueError("an upsert needs key columns")
    _refuse_history(target, allow_history_loss, "an upsert")
    if not small_work:
        return upsert_pass(target, work, keys).drop("_state")
    _, values = split_keys(target.columns, keys)
    kept = upserted(target, work, keys, small_work).drop("_hit") if values else target
    return kept.unionByName(unmatched(target, work, keys, small_work), allowMissingColumns=True)


def upsert_pass(target: DataFrame, work: DataFrame, keys: list[str]) -> DataFrame:
    """The target after an upsert, plus ``_state``: kept, updated or inserted. One join reads each side once."""
    keys, values = split_keys(target.columns, keys)
    source = _as_source(align(work, target), keys + values, keys)
    joined = _as_target(target, keys).withColumn("_there", F.lit(True)).join(source, _on(keys), "full")
    there, hit = F.coalesce("_there", F.lit(False)), F.coalesce("_hit", F.lit(False))
    state = F.when(~there, "inserted").when(hit & F.lit(bool(values)), "updated").otherwise("kept")
    out = {c: F.when(hit, F.col(_SRC + c)).otherwise(F.col(c)) for c in values}
    out |= {k: F.when(there, F.col(k)).otherwise(F.col(_SRC + k)) for k in keys}
    return joined.select(*[out.get(c, F.col(c)).alias(c) for c in target.columns], state.alias("_state"))


def _totals(inserted: DataFrame, updated: DataFrame | None = None, flagged: DataFrame | None = None) -> DataFrame:
    """One row of counts from the parts of a load, added up in a single aggregate."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    parts = inserted.select(one.alias("i"), none.alias("u"), none.alias("e"))
    if updated is not None:
        parts = parts.unionByName(updated.select(none.alias("i"), one.alias("u"), none.alias("e")))
    if flagged is not None:
        parts = parts.unionByName(flagged.select(none.alias("i"), none.alias("u"),
                                                 F.col("_expired").cast("long").alias("e")))
    return parts.agg(*[F.coalesce(F.sum(c), none).alias(f"rows_{name}")
                       for c, name in (("i", "inserted"), ("u", "updated"), ("e", "expired"))])


def scd1_counts(target: DataFrame, work: DataFrame, keys: list[str], small_work: bool = False) -> DataFrame:
    """One row: rows_inserted, rows_updated, rows_expired."""
    keys, values = split_keys(target.columns, keys)
    if not small_work:
        rows = upsert_pass(target.select(*keys).withColumn("_any", F.lit(0)),
                           work.select(*resolve(keys, work.columns)).withColumn("_any", F.lit(1)), keys)
        updated = F.count_if((F.col("_state") == "updated") & F.lit(bool(values)))
        return rows.agg(F.count_if(F.col("_state") == "inserted").alias("rows_inserted"), updated.alias("rows_updated"),
                        F.lit(0).cast("long").alias("rows_expired"))
    updated = (target.select(*keys).join(_sized(work.select(*keys), small_work), keys, "left_semi")
               if values else None)
    return _totals(unmatched(target, work, keys, small_work), updated)


def flag_changes(current: DataFrame, work: DataFrame, keys: list[str], run_ts,
                 compare: list[str] | None = None, null_safe: bool = False,
                 small_work: bool = False) -> DataFrame:
    """Current rows, expired where their work row differs, plus ``_expired`` and ``_hit``."""
    keys, values = split_keys(current.columns, keys)
    compare = resolve(compare, values) if compare is not None else values
    work = align(work, current)
    differs = row_differs(compare, current.schema, work.schema, _SRC, null_safe)
    source = _as_source(work, list(dict.fromkeys(keys + compare)), keys)
    joined = _as_target(current, keys).join(_sized(source, small_work), _on(keys), "left")
    marked = joined.withColumns({
        "_hit": F.coalesce("_hit", F.lit(False)),
        "_expired": F.coalesce(F.col("_hit") & differs, F.lit(False)),
    }).select(*current.columns, "_hit", "_expired")
    return marked.withColumns({
        "is_current": ~F.col("_expired"),
        "eff_end_date": F.when(F.col("_expired"), F.lit(run_ts).cast("timestamp_ntz")).otherwise(
            F.col("eff_end_date")),
    })


def without_current(work: DataFrame, still_current: DataFrame, keys: list[str]) -> DataFrame:
    """Work rows that no current row stands for. The keys are made distinct before the join."""
    return anti_join(work, still_current.select(*keys).dropna().distinct(), keys)


def scd2_parts(target: DataFrame, work: DataFrame, keys: list[str], run_ts,
               compare: list[str] | None = None, null_safe: bool = False,
               small_work: bool = False) -> HistoryParts:
    """SCD2 as its parts: closed rows, current rows (some now expired), new versions."""
    if not keys:
        raise ValueError("a history load needs key columns")
    keys, _ = split_keys(target.columns, keys)
    is_current = F.coalesce("is_current", F.lit(False))
    flagged = flag_changes(target.where(is_current), work, keys, run_ts, compare, null_safe, small_work)
    work = align(work, target)
    inserted = without_current(work, flagged.where("_hit and not _expired"), keys)
    return HistoryParts(target.where(~is_current), flagged, new_versions(inserted, run_ts))


def scd2(target: DataFrame, work: DataFrame, keys: list[str], run_ts, compare: list[str] | None = None,
         null_safe: bool = False, small_work: bool = False) -> DataFrame:
    """SCD2: close changed current rows and add their new versions and the new keys.

    Unchanged rows and keys missing from the work rows stay as they are. A target without
    history columns gets an SCD1 upsert instead.
    """
    if not has_history(target.columns):
        return scd1(target, work, keys, small_work)
    parts = scd2_parts(target, work, keys, run_ts, compare, null_safe, small_work)
    return (parts.history.unionByName(parts.flagged.drop("_hit", "_expired"))
            .unionByName(parts.inserted.select(*target.columns)))


def scd2_counts(target: DataFrame, work: DataFrame, keys: list[str], run_ts,
                compare: list[str] | None = None, null_safe: bool = False,
                small_work: bool = False) -> DataFrame:
    """One row: rows_inserted, rows_updated, rows_expired."""
    if not has_history(target.columns):
        return scd1_counts(target, work, keys, small_work)
    parts = scd2_parts(target, work, keys, run_ts, compare, null_safe, small_work)
    return _totals(parts.inserted, flagged=parts.flagged)


def load_kind(load_type: str | None, scd_type: int | None) -> str:
    """Which load operator a job asks for; what is unknown falls back as documented."""
    load_type = (load_type or "full").lower()
    if load_type == "filter":
        return "filter"
    if load_type != "incremental":
        return "full"
    return {0: "append", 2: "scd2"}.get(int(scd_type or 0), "scd1")


def apply_load(target: DataFrame, work: DataFrame, load_type: str, scd_type: int, keys: list[str],
               run_ts, condition: str | None = None, allow_history_loss: bool = False) -> DataFrame:
    """The load a job asks for, as a DataFrame."""
    kind = load_kind(load_type, scd_type)
    if kind == "filter":
        return filter_reload(target, work, condition, allow_history_loss)
    if kind == "append":
        return append(target, work, allow_history_loss)
    if kind == "scd2":
        return scd2(target, work, keys, run_ts)
    if kind == "scd1":
        return scd1(target, work, keys, allow_history_loss=allow_history_loss)
    return full_replace(target, work, allow_history_loss)
