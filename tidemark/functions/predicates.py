"""Row predicates: change windows, filters and row comparison."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F, types as T

# Window start and last id before the first run.
FIRST_START = "1900-01-01 00:00:00.000"
FIRST_ID = 0


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions) if conditions else F.lit(False)


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions) if conditions else F.lit(True)


def name_list(text: str | None) -> list[str]:
    """The names in a comma list."""
    return [part.strip() for part in (text or "").split(",") if part.strip()]


def as_timestamp(value) -> Column:
    """A window edge; text that is no time becomes NULL, so it selects nothing."""
    return F.lit(str(value)).try_cast("timestamp_ntz")


def time_window(columns: list[str], start, end) -> Column:
    """True where any of the columns lies in [start, end)."""
    low, high = as_timestamp(start or FIRST_START), as_timestamp(end)
    return any_of([(F.col(c) >= low) & (F.col(c) < high) for c in columns])


def id_window(column: str, last_id: int | None) -> Column:
    return F.col(column).try_cast("long") > F.lit(int(last_id or FIRST_ID))


def extract_condition(job: dict, watermark: dict | None, run_start) -> Column | None:
    """Which source rows a job reads; None means all of them."""
    load_type = (job.get("load_type") or "full").lower()
    if load_type == "filter":
        return F.expr(job["filter_condition"]) if job.get("filter_condition") else None
    columns = name_list(job.get("cdc_columns"))
    if load_type != "incremental" or not columns:
        return None
    watermark = watermark or {}
    kind = (job.get("cdc_type") or "TIMESTAMP").upper()
    if kind == "TIMESTAMP":
        return time_window(columns, watermark.get("window_end"), run_start)
    if kind == "ID":
        return id_window(columns[0], watermark.get("max_id"))
    return None


def _differs(left: str, right: str, same_type: bool, data_type: T.DataType) -> Column:
    # Fixed-width values differ as text exactly when they differ as values, and their
    # text is never empty, so only strings and binary need the text comparison.
    if same_type and not isinstance(data_type, (T.StringType, T.BinaryType, T.VariantType)):
        return ~F.col(left).eqNullSafe(F.col(right))
    empty = F.lit("")
    return F.coalesce(F.col(left).cast("string"), empty) != F.coalesce(F.col(right).cast("string"), empty)


def row_differs(columns: list[str], left: T.StructType, right: T.StructType, prefix: str,
                null_safe: bool = False) -> Column:
    """True where a column differs from its ``prefix``-ed partner.

    NULL and the empty string are equal, unless ``null_safe`` asks for strict
    comparison. With no columns to compare nothing differs.
    """
    if null_safe:
        return any_of([~F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns])
    return any_of([_differs(c, prefix + c, left[c].dataType == right[c].dataType, left[c].dataType)
                   for c in columns])

