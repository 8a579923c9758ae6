"""Source tables: whole, filtered, changed rows only, or a query."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import encrypt, numbered_text, trim_strings
from tidemark.functions.predicates import FIRST_START, extract_condition, name_list

# Names of the window parameters in a custom query.
WINDOW_PARAMETERS = ["extract_start_dttm", "extract_end_dttm"]

Reader = Callable[[dict], DataFrame]


def catalog_reader(spark: SparkSession) -> Reader:
    """Read ``source_db.source_table`` from the session catalog."""
    return lambda job: spark.table(f"{job['source_db']}.{job['source_table']}")


def parquet_reader(spark: SparkSession, folder: str) -> Reader:
    """Read ``<folder>/<source_table>.parquet``."""
    return lambda job: spark.read.parquet(f"{folder}/{job['source_table']}.parquet")


def jdbc_reader(spark: SparkSession, options: dict[str, str], split_column: str | None = None,
                lower: str | None = None, upper: str | None = None, splits: int = 1) -> Reader:
    """Read over JDBC. Filters are pushed down; with a split column many tasks read at once."""
    def read(job: dict) -> DataFrame:
        reader = spark.read.format("jdbc").options(**options).option(
            "dbtable", f"{job['source_schema']}.{job['source_table']}")
        if split_column:
            reader = reader.options(partitionColumn=split_column, lowerBound=lower, upperBound=upper,
                                    numPartitions=splits)
        return reader.load()
    return read


def split_bounds(rows: DataFrame, column: str, splits: int, accuracy: int = 10_000) -> list:
    """Values that cut a column into about equal numbers of rows: a quantile sketch, merged from partial ones. Fewer than asked for
    where one value holds more rows than a split."""
    at = [i / splits for i in range(1, splits)]
    found = rows.agg(F.percentile_approx(F.col(column), at, accuracy).alias("q")).first()["q"] if at else []
    return sorted(set(found or []))


def split_conditions(column: str, bounds: list) -> list[str]:
    """One condition per split, as SQL text for a partitioned read: together they take every row once, NULLs with the first."""
    def text(value) -> str:
        return str(value) if isinstance(value, (int, float)) else f"'{value}'"

    if not bounds:
        return ["1 = 1"]
    inner = [f"{column} > {text(a)} AND {column} <= {text(b)}" for a, b in zip(bounds, bounds[1:])]
    return [f"{column} <= {text(bounds[0])} OR {column} IS NULL", *inner, f"{column} > {text(bounds[-1])}"]


def jdbc_split_reader(spark: SparkSession, options: dict[str, str], bounds: Callable[[dict], tuple[str, list] | None]) -> Reader:
    """Read over JDBC with splits of each job's own: ``bounds`` gives a job's split column and its bounds, or None."""
    def read(job: dict) -> DataFrame:
        split, name = bounds(job), f"{job['source_schema']}.{job['source_table']}"
        if split is None:
            return spark.read.format("jdbc").options(**options).option("dbtable", name).load()
        rest = {k: v for k, v in options.items() if k != "url"}
        return spark.read.jdbc(options["url"], name, predicates=split_conditions(*split), properties=rest)
    return read


def run_query(spark: SparkSession, sql: str, tables: dict[str, DataFrame], start=None, end=None) -> DataFrame:
    """A user query over named tables (``{orders}``), with the window as ``:extract_start_dttm``
    and ``:extract_end_dttm``."""
    edges = (str(start or FIRST_START), str(end))
    used = {k: F.expr(f"timestamp_ntz'{datetime.fromisoformat(v)}'")
            for k, v in zip(WINDOW_PARAMETERS, edges) if f":{k}" in sql}
    return spark.sql(sql, args=used or None, **{n: t for n, t in tables.items() if "{" + n + "}" in sql})


def select_rows(source: DataFrame, condition: Column | None) -> DataFrame:
    """The rows to move; without a condition the table is read as it is."""
    return source if condition is None else source.where(condition)


def prepare(rows: DataFrame, job: dict, key: bytes | None = None) -> DataFrame:
    """Optional trimming and column encryption."""
    if (job.get("trim") or "N").upper() == "Y":
        rows = trim_strings(rows)
    secret = name_list(job.get("encryption_columns"))
    if secret:
        if key is None:
            raise ValueError("encryption_columns are set but no key was passed")
        rows = encrypt(rows, secret, key)
    return rows


def extract(spark: SparkSession, job: dict, read: Reader, watermark: dict | None, run_start,
            tables: dict[str, DataFrame] | None = None, key: bytes | None = None) -> DataFrame:
    """The rows one run of a job moves. A custom query wins over any condition."""
    if job.get("custom_sql"):
        start = (watermark or {}).get("window_end")
        rows = numbered_text(run_query(spark, job["custom_sql"], tables or {}, start, run_start))
    else:
        rows = select_rows(read(job), extract_condition(job, watermark, run_start))
    return prepare(rows, job, key)


def max_id(source: DataFrame, column: str) -> DataFrame:
    """One row: the highest id in a source, kept as the next id watermark."""
    return source.agg(F.max(F.col(column).cast("long")).alias("max_id"))
