"""Discovery: which tables there are, what identifies a row and what shows a change.

Parquet and catalog tables declare no key constraints, so keys are proved by counting.
"""

from __future__ import annotations

import fnmatch
import math
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import workspace

# Column name patterns for watermarks.
WATERMARK_PATTERNS = ["%modified%", "%updated%"]
KEY_PATTERN = r"(?i)(key|_id|^id)$"


def column_list(tables: dict[str, DataFrame]) -> list[tuple[str, int, str, str]]:
    """(table, position, column, type) from the schemas; no data is read."""
    return [(name, i, f.name, f.dataType.simpleString())
            for name, df in tables.items() for i, f in enumerate(df.schema)]


def key_candidates(df: DataFrame, pattern: str = KEY_PATTERN) -> list[str]:
    return [f.name for f in df.schema
            if re.search(pattern, f.name)
            and isinstance(f.dataType, (T.IntegralType, T.StringType))]



def key_profile(name: str, df: DataFrame, column: str) -> DataFrame:
    """One row: rows, non-null values, distinct values of a candidate, and is it a key.

    One column per scan: a single distinct count is pre-aggregated before its shuffle, while
    several in one aggregate would multiply the rows.
    """
    n_distinct = F.count_distinct(column)
    n_rows = F.count(F.lit(1))
    return df.agg(n_rows.alias("n_rows"), F.count(column).alias("n_values"), n_distinct.alias("n_distinct"),
                  ((n_distinct == n_rows) & (n_rows > 0)).alias("is_key")).select(
        F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "*")


def profile_keys(tables: dict[str, DataFrame], pattern: str = KEY_PATTERN) -> DataFrame:
    """Key candidates of many tables, each counted exactly. No row if there is no candidate."""
    parts = [key_profile(n, df, c) for n, df in tables.items() for c in key_candidates(df, pattern)]
    return _union(tables, parts, "table_name string, column_name string, n_rows long, n_values long, n_distinct long, "
                                 "is_key boolean")


def find_keys(tables: dict[str, DataFrame], pattern: str = KEY_PATTERN, spread: float = 0.02) -> DataFrame:
    """Like ``profile_keys``, but candidates that are far from unique are ruled out by one scan of their table.

    An estimate of all candidates' distinct counts comes first. Only where it is near the number of rows (its
    relative error is ``spread``; ten times that is allowed) is the column counted exactly; elsewhere ``n_distinct`` is NULL.
    """
    parts = []
    for name, df in tables.items():
        columns = key_candidates(df, pattern)
        if not columns:
            continue
        seen = df.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in (
            ("v", F.count), ("d", lambda c: F.approx_count_distinct(c, spread)))]).first()
        for i, c in enumerate(columns):
            if seen[f"d{i}"] >= (1 - 10 * spread) * seen["n"]:
                parts.append(key_profile(name, df, c))
            else:
                parts.append(df.sparkSession.range(1).select(
                    F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(seen["n"]).alias("n_rows"),
                    F.lit(seen[f"v{i}"]).alias("n_values"), F.lit(None).cast("long").alias("n_distinct"), F.lit(False).alias("is_key")))
    return _union(tables, parts, "table_name string, column_name string, n_rows long, n_values long, n_distinct long, "
                                 "is_key boolean")


def _union(tables: dict[str, DataFrame], parts: list[DataFrame], schema: str) -> DataFrame:
    if parts:
        return reduce(DataFrame.unionByName, parts)
    return (next(iter(tables.values())).sparkSession if tables else SparkSession.active()).createDataFrame([], schema)


def is_composite_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: does this set of columns identify every row? Counts per key are made map-side first."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    no_nulls = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return groups.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"),
                      F.coalesce((F.max("n") == 1) & F.bool_and(no_nulls), F.lit(False)).alias("is_key"))


def composite_candidates(df: DataFrame, pattern: str = KEY_PATTERN) -> list[tuple[str, str]]:
    """Pairs that may identify a row together: a column named like a key, and another whole-number or key-like column."""
    first = key_candidates(df, pattern)
    second = first + [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType) and f.name not in first]
    pairs = [(a, b) for i, a in enumerate(second) for b in second[i + 1:] if a in first]
    return pairs


def profile_composite_keys(tables: dict[str, DataFrame], pattern: str = KEY_PATTERN) -> DataFrame:
    """Pairs of columns of tables in which no single column is a key, each counted exactly."""
    parts = [is_composite_key(df, list(pair)).select(F.lit(name).alias("table_name"),
                                                     F.lit(", ".join(pair)).alias("column_name"), "*")
             for name, df in tables.items() for pair in composite_candidates(df, pattern)]
    return _union(tables, parts, "table_name string, column_name string, n_rows long, n_distinct long, is_key boolean")


def watermark_candidates(df: DataFrame, patterns: list[str] | None = None) -> list[str]:
    """Columns whose name says change time, then other timestamp columns, in table order."""
    wanted = [p.replace("%", "*") for p in (patterns or WATERMARK_PATTERNS)]
    named = [c for c in df.columns if any(fnmatch.fnmatch(c.lower(), p) for p in wanted)]
    times = [f.name for f in df.schema
             if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) and f.name not in named]
    return named + times


def profile_watermarks(tables: dict[str, DataFrame]) -> DataFrame:
    """Watermark candidates with their range and gaps."""
    parts = []
    for name, df in tables.items():
        columns = [c for c in watermark_candidates(df)
                   if isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType))]
        if not columns:
            continue
        wide = df.agg(F.count(F.lit(1)).alias("n_rows"),
                      *[f(c).alias(f"{k}{i}") for i, c in enumerate(columns)
                        for k, f in (("lo", F.min), ("hi", F.max), ("v", F.count))])
        parts.append(wide.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                     F.col(f"lo{i}").alias("first_value"), F.col(f"hi{i}").alias("last_value"),
                     (F.col("n_rows") - F.col(f"v{i}")).alias("n_nulls"))
            for i, c in enumerate(columns)]))))
    kinds = {str(df.schema[c].dataType.simpleString()) for _, df in tables.items() for c in watermark_candidates(df)
             if isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType))}
    kind = kinds.pop() if len(kinds) == 1 else "timestamp_ntz"
    return _union(tables, parts, f"table_name string, column_name string, first_value {kind}, last_value {kind}, n_nulls long")


def suggest_jobs(keys: DataFrame, watermarks: DataFrame, tables: DataFrame, source_db: str,
                 composite: DataFrame | None = None, patterns: list[str] | None = None) -> DataFrame:
    """A settings row per table: incremental if it has a key and a column whose name says change time, else full.

    A single key column comes before a pair. Of several change columns the one whose pattern comes first is
    taken: a time of creation, or any other time, says nothing about later changes and never counts.
    """
    single = keys.where("is_key").groupBy("table_name").agg(F.min("column_name").alias("one"))
    pairs = (composite if composite is not None else keys.limit(0)).where("is_key").groupBy("table_name").agg(
        F.min("column_name").alias("two"))
    key = single.join(pairs, "table_name", "full").select("table_name", F.coalesce("one", "two").alias("primary_key"))
    place = F.lit(None).cast("int")
    for i, pattern in reversed(list(enumerate(patterns or WATERMARK_PATTERNS))):
        place = F.when(F.lower("column_name").like(pattern), i).otherwise(place)
    mark = (watermarks.withColumn("place", place).where("place is not null").groupBy("table_name")
            .agg(F.min_by("column_name", F.struct("place", "column_name")).alias("cdc_columns")))
    both = F.col("primary_key").isNotNull() & F.col("cdc_columns").isNotNull()
    return (tables.join(key, "table_name", "left").join(mark, "table_name", "left").select(
        F.lit(source_db).alias("source_db"), F.col("table_name").alias("source_table"),
        F.upper("table_name").alias("target_table"), "primary_key", "cdc_columns",
        F.when(both, "incremental").otherwise("full").alias("load_type")))


def not_configured(found: DataFrame, config: DataFrame) -> DataFrame:
    """Found tables that no settings row names yet."""
    known = config.select("source_db", "source_table").distinct()
    return found.join(known, ["source_db", "source_table"], "left_anti")


def catalog_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The base tables of a catalog database."""
    return {t.name: spark.table(f"{database}.{t.name}") for t in spark.catalog.listTables(database)
            if t.tableType in ("MANAGED", "EXTERNAL")}


# -- unique column combinations of any width ---------------------------------------------

#: A sketch's error is far below this, so a combination counted lower by it is surely not unique.
SKETCH_SLACK = 0.15
#: Combinations that are sketched in one pass over a table.
AT_ONCE = 60
#: Tables of more rows have combinations counted over one value in so many before all of them are.
PARTS_FROM = 1_000_000
PARTS = 64


def _comparable(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.IntegralType, T.StringType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType,
                                       T.BooleanType))


def _no_repeat(rows: DataFrame, c: tuple[str, ...]) -> bool:
    return rows.groupBy(*[F.col(f"`{x}`") for x in c]).count().filter("count > 1").isEmpty()


def _repeated(rows: DataFrame, c: tuple[str, ...]) -> DataFrame:
    """The rows that a combination does not tell apart, written; its columns are never NULL."""
    names = [f"`{x}`" for x in c]
    often = rows.groupBy(*[F.col(x) for x in names]).count().filter("count > 1").drop("count")
    folder = workspace(rows.sparkSession, "repeated")
    rows.join(often, list(c), "left_semi").select(*rows.columns).write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _unique(rows: DataFrame, near: list[tuple[str, ...]], counted: dict[tuple, int], n: int) -> list[tuple[str, ...]]:
    """Those of some combinations that tell every row apart, in their order.

    Whole groups of one value in ``PARTS`` are counted first: a repeat among them rules a combination out. What is left is counted
    over all rows or, as rows that share their values in a combination share them in each narrower one, over the rows
    that a narrower combination leaves together. Those rows are found once for all combinations that hold it.
    """
    if n > PARTS_FROM:
        near = [c for c in near if _no_repeat(rows.where(F.pmod(F.xxhash64(*[F.col(f"`{x}`") for x in c]), F.lit(PARTS)) == 0), c)]
    by_part: dict[tuple, list[tuple]] = {}
    for c in near:
        inner = max((c[:i] + c[i + 1:] for i in range(len(c))), key=lambda p: counted.get(p, 0))
        by_part.setdefault(inner if counted.get(inner, 0) >= n / 2 else (), []).append(c)
    found = []
    for inner, wider in by_part.items():
        base = _repeated(rows, inner) if inner and len(wider) > 1 else rows
        found += [c for c in wider if _no_repeat(base, c)]
    return [c for c in near if c in set(found)]


def minimal_keys(df: DataFrame, width: int | None = None) -> list[tuple[str, ...]]:
    """All minimal combinations of columns (up to ``width``) that are never NULL and tell every row apart.

    The lattice of combinations is searched level by level. A combination goes on only if it holds no key, and if the product of
    its columns' distinct counts reaches the number of rows. One pass sketches the distinct counts of a level; only
    combinations that may be unique by their sketch are counted exactly, first over a part of their values and then, where several
    hold the same narrower combination, over the rows that this one does not tell apart.
    """
    fields = [f.name for f in df.schema if _comparable(f)]
    facts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(f"`{c}`").alias(f"v{i}") for i, c in enumerate(fields)],
                   *[F.approx_count_distinct(f"`{c}`", 0.02).alias(f"d{i}") for i, c in enumerate(fields)]).first()
    n = facts["n"]
    columns = [c for i, c in enumerate(fields) if facts[f"v{i}"] == n]
    distinct = {c: facts[f"d{i}"] * (1 + SKETCH_SLACK) + 1 for i, c in enumerate(fields)}
    keys: list[tuple[str, ...]] = []
    counted: dict[tuple, int] = {}
    level = [(c,) for c in columns]
    while level:
        # a combination whose columns cannot tell so many rows apart is no key, but a wider one may be
        able = [c for c in level if math.prod(distinct[x] for x in c) >= n]
        sketched: dict[tuple, int] = {}
        for s in range(0, len(able), AT_ONCE):
            some = able[s:s + AT_ONCE]
            row = df.agg(*[F.approx_count_distinct(F.xxhash64(*[F.col(f"`{x}`") for x in c]), 0.02).alias(f"d{i}")
                           for i, c in enumerate(some)]).first()
            sketched.update({c: row[f"d{i}"] for i, c in enumerate(some)})
        counted.update(sketched)
        near = [c for c in able if sketched[c] >= (1 - SKETCH_SLACK) * n]
        keys += _unique(df.select(*[F.col(f"`{x}`") for x in columns]), near, counted, n)
        found = set(keys)
        if width and len(level[0]) >= width:
            break
        alive = {c for c in level if c not in found}
        place = {c: i for i, c in enumerate(columns)}
        wider = []
        for c in sorted(alive, key=lambda c: [place[x] for x in c]):
            for x in columns[place[c[-1]] + 1:]:
                new = (*c, x)
                if all(new[:i] + new[i + 1:] in alive for i in range(len(new))):
                    wider.append(new)
        level = wider
    return keys


def profile_minimal_keys(spark: SparkSession, tables: dict[str, DataFrame], width: int | None = None) -> DataFrame:
    """(table_name, columns, width) of every minimal key of some tables."""
    rows = [(name, ", ".join(c), len(c)) for name, df in tables.items() for c in minimal_keys(df, width)]
    return spark.createDataFrame(rows, "table_name string, columns string, width int")
