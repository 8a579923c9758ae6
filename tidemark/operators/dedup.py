"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.types import resolve


def latest_first(df: DataFrame, keys: list[str], newest: list[str]) -> list[Column]:
    """Newest rows first, then by every other column that has an order, so that the choice is repeatable."""
    newest = resolve(newest, df.columns)
    rest = [f.name for f in df.schema if f.name not in newest and f.name not in keys
            and not isinstance(f.dataType, (T.VariantType, T.MapType))]
    return [F.col(c).desc_nulls_last() for c in newest] + [F.col(c).asc_nulls_first() for c in rest]


def dedup(df: DataFrame, keys: list[str], newest: list[str] | None = None) -> DataFrame:
    """Keep the newest row of each key.

    Spark cuts each input partition down to one row per key before the shuffle
    (WindowGroupLimit), so a key that holds a large share of all rows costs one
    row per partition and not one huge task.
    """
    keys = resolve(keys, df.columns)
    order = latest_first(df, keys, newest or [])
    window = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
