"""Columns of sources, targets made from them, tables of the catalog, and custom queries with a filter load."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.common import TABLES, check, table
from tidemark.functions.types import column_metadata
from tidemark.operators.ledger import Ledger
from tidemark.plans import job as jobs
from tidemark.session import workspace
from tidemark.sources import discover
from tidemark.sources.tables import catalog_reader, parquet_reader

_PLAIN = ["region", "nation", "customer", "supplier", "part", "orders", "events"]
_KEYS = dict(zip(_PLAIN, ["r_regionkey", "n_nationkey", "c_custkey", "s_suppkey", "p_partkey", "o_orderkey", "event_id"]))
_HISTORY = {"is_current": "bit", "eff_start_date": "datetime2", "eff_end_date": "datetime2"}
_KINDS = """CASE WHEN data_type = 'BIGINT' THEN 'bigint' WHEN data_type = 'INTEGER' THEN 'int' WHEN data_type = 'DOUBLE' THEN 'float'
  WHEN data_type = 'VARCHAR' THEN 'varchar' WHEN data_type = 'BOOLEAN' THEN 'bit' WHEN data_type = 'DATE' THEN 'date'
  WHEN data_type LIKE 'DECIMAL%' THEN 'decimal' WHEN data_type = 'TIMESTAMP WITH TIME ZONE' THEN 'datetimeoffset'
  WHEN data_type LIKE 'TIMESTAMP%' THEN 'datetime2' END"""


def _counts(name: str) -> str:
    return (f"SELECT '{name}' AS table_name, column_name, n FROM (UNPIVOT (SELECT COUNT(COLUMNS(*)) AS '\\0' FROM {name}) "
            "ON COLUMNS(*) INTO NAME column_name VALUE n)")


def _columns(name: str, df) -> list:
    """(table, column, its type at the source, rows that have it), one row per column."""
    metas = column_metadata(df)
    counted = df.agg(*[F.count(F.col(f"`{m.name}`")).alias(f"c{i}") for i, m in enumerate(metas)])
    entries = F.array(*[F.struct(F.lit(m.name).alias("column_name"), F.lit(i + 1).alias("place"), F.lit(m.data_type).alias("kind"),
                                 F.col(f"c{i}").alias("n")) for i, m in enumerate(metas)])
    return counted.select(F.lit(name).alias("table_name"), F.inline(entries))


@check(f"""WITH counted AS ({' UNION ALL '.join(_counts(t) for t in _PLAIN)})
  SELECT table_name, column_name, CAST(ordinal_position AS INTEGER) AS place, {_KINDS} AS kind, n
  FROM counted JOIN information_schema.columns USING (table_name, column_name)""")
def column_profile(spark, sf):
    """Names and source types of the columns of some tables, and how many rows have each."""
    parts = [_columns(t, table(spark, sf, t)) for t in _PLAIN]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@check(f"""WITH counted AS ({' UNION ALL '.join(_counts(t) for t in _PLAIN)}),
  sizes AS ({' UNION ALL '.join(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS width, count(*) AS n FROM {t}" for t in _PLAIN)})
  SELECT table_name, column_name, CAST(ordinal_position AS INTEGER) AS place, {_KINDS} AS kind, n
  FROM counted JOIN information_schema.columns USING (table_name, column_name)
  UNION ALL SELECT table_name, column_name, CAST(width + nr AS INTEGER), kind, CASE WHEN nr = 3 THEN 0 ELSE n END FROM sizes,
    (VALUES {', '.join(f"({i}, '{c}', '{k}')" for i, (c, k) in enumerate(_HISTORY.items(), 1))}) AS h(nr, column_name, kind)""")
def created_targets(spark, sf):
    """Targets that jobs made from their sources: their columns, the history columns included, and the rows that have each."""
    root = workspace(spark, "created")
    place = jobs.Place(spark, parquet_reader(spark, sf), f"{root}/stage", f"{root}/targets", Ledger(spark, f"{root}/ledger"))
    settings = [{"source_db": "sales", "source_schema": "dbo", "source_table": t, "target_db": "ANALYTICS", "target_schema": "PUBLIC",
                 "target_table": t.upper(), "load_type": "incremental", "scd_type": 2, "primary_key": _KEYS[t]} for t in _PLAIN]
    jobs.run_many(place, settings).collect()
    out = None
    for job in settings:
        part = _columns(job["source_table"], place.target(job).read())
        out = part if out is None else out.unionByName(part)
    return out


@check(" UNION ALL ".join([*[f"SELECT '{t}' AS table_name, true AS found, count(*) AS n FROM {t}" for t in TABLES],
                           "SELECT 'missing', false, 0"]))
def catalog_inventory(spark, sf):
    """Tables of a catalog database that are there, and their rows read by the catalog's reader."""
    database = "tables_" + workspace(spark, "catalog").rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{workspace(spark, 'catalog')}'")
    for name in TABLES:
        spark.catalog.createTable(f"{database}.{name}", path=f"{sf}/{name}.parquet", source="parquet")
    found, read, out = discover.catalog_tables(spark, database), catalog_reader(spark), None
    for name in [*TABLES, "missing"]:
        there = name in found and spark.catalog.tableExists(f"{database}.{name}")
        rows = read({"source_db": database, "source_table": name}) if there else spark.range(0)
        part = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.lit(there).alias("found"), "n")
        out = part if out is None else out.unionByName(part)
    return out


_YEAR = "o_orderdate >= TIMESTAMP '1996-01-01'"


@check(f"""SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(o_totalprice AS DOUBLE) AS price FROM orders WHERE NOT ({_YEAR})
  UNION ALL SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(o_totalprice AS DOUBLE) * 2 FROM orders WHERE {_YEAR}""")
def custom_query_filter_load(spark, sf):
    """A custom query with a filter load: the rows that the condition names are dropped and moved again, the others stay."""
    root = workspace(spark, "reload")
    place = jobs.Place(spark, parquet_reader(spark, sf), f"{root}/stage", f"{root}/targets", Ledger(spark, f"{root}/ledger"))
    place.custom_tables["orders"] = table(spark, sf, "orders")
    query = "SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(o_totalprice AS DOUBLE) * {} AS price FROM {{orders}}"
    job = {"source_db": "sales", "source_schema": "dbo", "source_table": "orders", "target_db": "ANALYTICS", "target_schema": "PUBLIC",
           "target_table": "ORDERS", "scd_type": 0}
    first = jobs.run_table(place, {**job, "load_type": "full", "custom_sql": query.format(1)}, "FULL", 10000, datetime(2024, 1, 1))
    again = jobs.run_table(place, {**job, "load_type": "filter", "custom_sql": query.format(2) + f" WHERE {_YEAR}",
                                   "filter_condition": _YEAR}, "FULL", 10001, datetime(2024, 2, 1))
    for done in (first, again):
        if done["status"] != "SUCCESS":
            raise RuntimeError(str(done))
    return place.target(job).read()
