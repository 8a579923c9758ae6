"""Discovery, counts and reconciliation over all tables."""

from pyspark.sql import functions as F

from checks.common import TABLES, check, table
from checks.loads import _DELTA, orders_delta
from checks.settings import CONFIG, config
from tidemark.operators import merge
from tidemark.plans import reports
from tidemark.sources import discover

_KEYS = {"customer": ["c_custkey", "c_nationkey"], "events": ["event_id", "user_id"], "orders": ["o_orderkey", "o_custkey"],
         "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"], "documents": ["doc_id"], "pages": ["page_id"],
         "part": ["p_partkey"], "conversations": ["conv_id"], "labels": ["doc_id"],
         "nation": ["n_nationkey", "n_regionkey"], "region": ["r_regionkey"], "supplier": ["s_suppkey", "s_nationkey"],
         "embeddings": ["vec_id"], "benchmark": ["item_id"]}


@check(" UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_values,
    count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) = count(*) AND count(*) > 0 AS is_key FROM {t}"""
    for t, cs in _KEYS.items() for c in cs))
def discover_keys(spark, sf):
    return discover.profile_keys({t: table(spark, sf, t) for t in TABLES})


@check("""SELECT count(*) AS n_rows, count(DISTINCT (conv_id, turn)) AS n_distinct,
            count(DISTINCT (conv_id, turn)) = count(*) AS is_key FROM conversations
          UNION ALL SELECT count(*), count(DISTINCT (l_orderkey, l_linenumber)),
            count(DISTINCT (l_orderkey, l_linenumber)) = count(*) FROM lineitem""")
def discover_composite_keys(spark, sf):
    return discover.is_composite_key(table(spark, sf, "conversations"), ["conv_id", "turn"]).unionByName(
        discover.is_composite_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))


@check(" UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, min({c}) AS first_value, max({c}) AS last_value,
    count(*) - count({c}) AS n_nulls FROM {t}"""
    for t, c in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))))
def discover_watermarks(spark, sf):
    return discover.profile_watermarks({t: table(spark, sf, t) for t in TABLES})


# Change times as a source would name them: events have a time of creation too, line items a time that says nothing.
_RENAMED = {"orders": {"o_orderdate": "last_updated"}, "events": {"ts": "modified_at"}}


def _first_key(t: str, columns: list[str]) -> str:
    """The first single key column by name, as SQL."""
    cases = " ".join(f"WHEN count(*) > 0 AND count(DISTINCT {c}) = count(*) THEN '{c}'" for c in sorted(columns))
    return f"(SELECT CASE {cases} END FROM {t})"


def _first_pair(t: str, pairs: list[tuple[str, str]]) -> str:
    cases = " ".join(f"""WHEN count(*) > 0 AND count(*) = count(DISTINCT ({a}, {b})) AND count({a}) = count(*)
      AND count({b}) = count(*) THEN '{a}, {b}'""" for a, b in sorted(pairs, key=lambda p: ", ".join(p)))
    return f"(SELECT CASE {cases} END FROM {t})"


_PAIRS = {"conversations": [("conv_id", "turn")],
          "lineitem": [("l_orderkey", "l_partkey"), ("l_orderkey", "l_suppkey"), ("l_partkey", "l_suppkey"),
                       ("l_orderkey", "l_linenumber"), ("l_partkey", "l_linenumber"), ("l_suppkey", "l_linenumber")]}


@check("""SELECT table_name AS source_table, upper(table_name) AS target_table, primary_key, cdc_columns,
            CASE WHEN primary_key IS NOT NULL AND cdc_columns IS NOT NULL THEN 'incremental' ELSE 'full' END AS load_type
          FROM (""" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, coalesce({_first_key(t, _KEYS[t])}, "
    f"{_first_pair(t, _PAIRS[t]) if t in _PAIRS else 'NULL'}) AS primary_key, "
    + {"orders": "'last_updated'", "events": "'modified_at'"}.get(t, "NULL") + " AS cdc_columns" for t in TABLES) + ")")
def discover_suggested_jobs(spark, sf):
    """Every table: a single key or a pair, and a watermark only where the name says change time."""
    found = {t: table(spark, sf, t).withColumnsRenamed(_RENAMED.get(t, {})) for t in TABLES}
    found["events"] = found["events"].withColumn("created_at", F.col("modified_at"))
    names = spark.createDataFrame([(t,) for t in found], "table_name string")
    pairs = {t: found[t] for t in _PAIRS}
    return discover.suggest_jobs(discover.find_keys(found), discover.profile_watermarks(found), names, "sales",
                                 discover.profile_composite_keys(pairs)).drop("source_db")


@check(f"""WITH {CONFIG} SELECT 'SALES' AS source_db, c_name AS source_table FROM customer
          WHERE NOT EXISTS (SELECT 1 FROM config WHERE source_db = 'SALES' AND source_table = c_name)""")
def discover_new_tables(spark, sf):
    """Tables of one database that no settings row names."""
    found = table(spark, sf, "customer").select(F.lit("SALES").alias("source_db"), F.col("c_name").alias("source_table"))
    return discover.not_configured(found, config(spark, sf))


@check(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def union_counts(spark, sf):
    return reports.counted({t: table(spark, sf, t) for t in TABLES})


@check("""SELECT 'events' AS table_name, count(*) AS n_changed FROM events WHERE ts >= TIMESTAMP '2024-01-20'
          UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '2024-01-20'
          UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_shipdate >= TIMESTAMP '2024-01-20'""")
def recent_changes(spark, sf):
    return reports.recent_changes({t: (table(spark, sf, t), c) for t, c in (
        ("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))}, "2024-01-20 00:00:00")


@check(f"""WITH {_DELTA}, n AS (SELECT count(*) AS n FROM delta WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders))
          SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS source_count,
            (SELECT count(*) FROM orders) + n AS target_count, n AS difference, n = 0 AS matches FROM n
          UNION ALL SELECT 'part', count(*), count(*), 0, true FROM part
          UNION ALL SELECT 'customer', count(*), NULL, -count(*), count(*) = 0 FROM customer""")
def reconcile_counts(spark, sf):
    orders, part = table(spark, sf, "orders"), table(spark, sf, "part")
    source = reports.counted({"orders": orders, "part": part, "customer": table(spark, sf, "customer")})
    target = reports.counted({"orders": merge.scd1(orders, orders_delta(spark, sf), ["o_orderkey"]), "part": part})
    return reports.reconcile(source, target)


@check("SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10")
def newest_rows(spark, sf):
    return reports.newest_rows(table(spark, sf, "orders"), "o_orderdate", "o_orderkey")


@check("SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def lookup_rows(spark, sf):
    return reports.lookup(table(spark, sf, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"])
