"""Digests of rows: 32 bytes that stand for the values of some columns.

A value goes in as its text with its length before it, so that no two rows share a text by running into each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _text(column: str, kind: T.DataType) -> Column:
    value = F.col("`" + column.replace("`", "``") + "`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0).cast(kind)  # -0.0 and 0.0 are one value
    if isinstance(kind, T.VariantType):
        return F.to_json(value)
    if isinstance(kind, T.BinaryType):
        return F.hex(value)  # bytes need not be text
    return value.cast("string")


def row_digest(rows: DataFrame, columns: list[str], null_safe: bool = False) -> Column:
    """SHA-256 over the columns. NULL and empty text are one value, unless ``null_safe`` keeps them apart."""
    parts = []
    for name in columns:
        text = _text(name, rows.schema[name].dataType)
        size = F.octet_length(F.coalesce(text, F.lit(""))).cast("string")
        if null_safe:
            size = F.when(text.isNull(), F.lit("-")).otherwise(size)
        parts += [size, F.lit(":"), F.coalesce(text, F.lit(""))]
    return F.unhex(F.sha2(F.concat(F.lit(""), *parts), 256))
