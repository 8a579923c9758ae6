"""What the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back.

    This cuts the lineage, so that a lost executor costs a read and not a second computation, and
    gives the optimizer the true size of what follows.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def without(df: DataFrame, *names: str) -> DataFrame:
    """The table without columns of these names (compared without case): an operator's own columns replace them."""
    gone = {n.lower() for n in names}
    return df.select(*[col(c) for c in df.columns if c.lower() not in gone])


def col(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    return F.coalesce(col(name), F.lit(""))
