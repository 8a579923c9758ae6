"""De-duplication and the load operators without history."""

from pyspark.sql import functions as F

from checks.common import check, table
from checks.history import scd2_sql
from tidemark.functions.types import column_metadata, target_schema, with_history
from tidemark.operators import merge, narrow
from tidemark.operators.dedup import dedup
from tidemark.operators.target import Target
from tidemark.session import workspace
from tidemark.sources.tables import run_query

_DEDUP = """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
    l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST,
    l_linestatus NULLS FIRST) = 1"""


@check(_DEDUP)
def dedup_by_key(spark, sf):
    return dedup(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@check("""SELECT user_id, event_type, ts, value FROM events QUALIFY row_number() OVER (
            PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1""")
def dedup_latest_event(spark, sf):
    rows = dedup(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"])
    return rows.select("user_id", "event_type", "ts", "value")


# The change batch: every order of the last window moves on, and every purchase event is a new order.
_DELTA = """delta AS (
  SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + 1000 AS o_totalprice, o_orderdate,
    o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
  UNION ALL
  SELECT 1000000000 + event_id, user_id, 'P', value, ts, NULL FROM events WHERE event_type = 'purchase')"""


def orders_delta(spark, sf):
    orders, events = table(spark, sf, "orders"), table(spark, sf, "events")
    moved = orders.where("o_orderdate >= timestamp_ntz'2000-01-01'").withColumns({
        "o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + 1000})
    new = events.where("event_type = 'purchase'").select(
        (F.lit(1000000000) + F.col("event_id")).alias("o_orderkey"), F.col("user_id").alias("o_custkey"),
        F.lit("P").alias("o_orderstatus"), F.col("value").alias("o_totalprice"), F.col("ts").alias("o_orderdate"),
        F.lit(None).cast("string").alias("o_orderpriority"))
    return moved.unionByName(new)


@check(f"WITH {_DELTA} SELECT * FROM orders UNION ALL SELECT * FROM delta")
def scd0_append(spark, sf):
    return merge.append(table(spark, sf, "orders"), orders_delta(spark, sf))


@check(f"""WITH {_DELTA} SELECT * FROM delta UNION ALL
          SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = orders.o_orderkey)""")
def scd1_upsert(spark, sf):
    return merge.scd1(table(spark, sf, "orders"), orders_delta(spark, sf), ["O_ORDERKEY"])


@check(f"""WITH {_DELTA} SELECT * FROM delta UNION ALL
          SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = orders.o_orderkey)""")
def scd1_filtered(spark, sf):
    """The upsert with orders that cannot match sent around its join."""
    return narrow.upsert_filtered(table(spark, sf, "orders"), orders_delta(spark, sf), ["O_ORDERKEY"])


@check(f"""WITH {_DELTA} SELECT
            (SELECT count(*) FROM delta d WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = d.o_orderkey))
              AS rows_inserted,
            (SELECT count(*) FROM orders o WHERE EXISTS (SELECT 1 FROM delta d WHERE o.o_orderkey = d.o_orderkey))
              AS rows_updated, CAST(0 AS BIGINT) AS rows_expired""")
def scd1_counts(spark, sf):
    return merge.scd1_counts(table(spark, sf, "orders"), orders_delta(spark, sf), ["o_orderkey"])


@check("""SELECT DISTINCT l_partkey, l_suppkey FROM lineitem""")
def scd1_all_key_columns(spark, sf):
    pairs = table(spark, sf, "lineitem")
    keys = ["l_partkey", "l_suppkey"]
    old = pairs.where("l_shipdate < timestamp_ntz'1998-06-01'").select(*keys).distinct()
    new = dedup(pairs.where("l_shipdate >= timestamp_ntz'1998-06-01'").select(*keys), keys)
    return merge.scd1(old, new, keys)


@check(f"""WITH s AS ({_DEDUP.replace('lineitem', '(SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM lineitem)')})
          SELECT l.l_orderkey, l.l_linenumber, s.l_partkey, s.l_quantity, s.l_returnflag FROM lineitem l
          JOIN s ON l.l_orderkey = s.l_orderkey AND l.l_linenumber = s.l_linenumber""")
def scd1_duplicate_target_keys(spark, sf):
    """A target that holds a key more than once: every such row is updated, none is dropped."""
    lines = table(spark, sf, "lineitem")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"]
    work = dedup(lines.withColumn("l_quantity", F.col("l_quantity") + 1), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return merge.scd1(lines.select(*columns), work, ["l_orderkey", "l_linenumber"])


@check("""SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_custkey END AS id, c_name AS name FROM customer
          UNION ALL SELECT NULL, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def scd1_null_keys(spark, sf):
    """NULL keys match nothing, so such rows are inserted again by every load."""
    rows = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"))
    return merge.scd1(rows, rows, ["id"])


def _orders_target(spark, sf, slices=1):
    orders = table(spark, sf, "orders")
    target = Target(spark, workspace(spark, "orders")).create(
        target_schema(column_metadata(orders)), ["o_orderkey"], slices)
    target.seed(orders)
    return target


@check(f"WITH {_DELTA} SELECT * FROM delta")
def full_replace(spark, sf):
    target = _orders_target(spark, sf)
    target.replace(orders_delta(spark, sf))
    return target.read()


@check("SELECT * FROM orders")
def full_replace_keeps_old_version(spark, sf):
    """After a replace the version before it can still be read."""
    target = _orders_target(spark, sf)
    before = target.versions()[-1]
    target.replace(orders_delta(spark, sf))
    return target.read(before)


@check(f"""WITH {_DELTA} SELECT * FROM delta UNION ALL
          SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = orders.o_orderkey)""")
def upsert_sliced_target(spark, sf):
    """The upsert written to a target of eight slices."""
    target = _orders_target(spark, sf, 8)
    folder = workspace(spark, "delta")
    orders_delta(spark, sf).write.parquet(folder)
    target.upsert(spark.read.parquet(folder))
    return target.read()


@check("""SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_totalprice END
            AS o_totalprice, o_orderdate, o_orderpriority FROM orders
          WHERE NOT (o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))""")
def update_and_delete_rows(spark, sf):
    target = _orders_target(spark, sf, 4)
    target.update("o_orderstatus in ('O')", {"o_totalprice": F.lit(0.0)})
    target.delete("o_orderstatus = 'P' and o_orderpriority in ('1-URGENT', '2-HIGH')")
    return target.read()


@check("""SELECT c_nationkey AS nation, c_mktsegment AS segment, count(*) AS n, sum(CAST(c_acctbal AS DECIMAL(18,2)))
            AS balance FROM customer GROUP BY ALL""")
def custom_sql_load(spark, sf):
    """The result of a query takes the place of the target's rows."""
    sql = ("SELECT c_nationkey AS nation, c_mktsegment AS segment, count(*) AS n, "
           "sum(CAST(c_acctbal AS DECIMAL(18,2))) AS balance FROM {customer} GROUP BY 1, 2")
    rows = run_query(spark, sql, {"customer": table(spark, sf, "customer")})
    target = Target(spark, workspace(spark, "segments")).create(target_schema(column_metadata(rows)))
    target.seed(rows.limit(0))
    target.replace(rows)
    return target.read()


@check("""SELECT * FROM orders WHERE NOT coalesce(o_orderstatus = 'F' AND o_totalprice > 100000, false)
          UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2, o_orderdate, o_orderpriority
          FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def filter_reload(spark, sf):
    condition = "o_orderstatus = 'F' AND o_totalprice > 100000"
    orders = table(spark, sf, "orders")
    work = orders.where(condition).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return merge.filter_reload(orders, work, condition)


_NULLED = """nulled AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END
  AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders)"""


@check(f"""WITH {_NULLED} SELECT * FROM nulled WHERE o_orderstatus IS NULL OR o_orderstatus <> 'F'
          UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F'""")
def filter_reload_null_condition(spark, sf):
    """Target rows on which the condition is NULL stay."""
    orders = table(spark, sf, "orders")
    target = orders.withColumn("o_orderstatus", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus")))
    return merge.filter_reload(target, orders.where("o_orderstatus = 'F'"), "o_orderstatus = 'F'")


@check("""SELECT * FROM orders WHERE o_orderstatus <> 'F' UNION ALL
          SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def filter_reload_target(spark, sf):
    """The filtered reload written to a target of four slices."""
    target = _orders_target(spark, sf, 4)
    target.reload(table(spark, sf, "orders").where("o_orderstatus = 'F' AND o_totalprice > 100000"), "o_orderstatus = 'F'")
    return target.read()


@check("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def filter_reload_empty_condition(spark, sf):
    """An empty condition drops everything before the work rows are added."""
    orders = table(spark, sf, "orders")
    return merge.filter_reload(orders, orders.where("o_orderstatus = 'F'"), None)


_COLS = ["o_orderkey", "o_totalprice", "o_orderstatus"]
_NONE = "CAST(NULL AS BOOLEAN) AS is_current, CAST(NULL AS TIMESTAMP) AS eff_start_date, CAST(NULL AS TIMESTAMP) AS eff_end_date"


def _plain(load: str, source: str) -> str:
    return f"SELECT '{load}' AS load, {', '.join(_COLS)}, {_NONE} FROM {source}"


@check(f"""WITH {_DELTA}, d AS (SELECT {', '.join(_COLS)} FROM delta),
  t AS (SELECT {', '.join(_COLS)}, true AS is_current, TIMESTAMP '2023-01-01' AS eff_start_date,
    CAST(NULL AS TIMESTAMP) AS eff_end_date FROM orders),
  {scd2_sql('t', 'd', ['o_orderkey'], _COLS, '2024-01-01 00:00:00')}
  {_plain('full', 'd')} UNION ALL {_plain('append', 'orders')} UNION ALL {_plain('append', 'd')}
  UNION ALL {_plain('upsert', 'd')} UNION ALL {_plain('upsert', 'orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM d)')}
  UNION ALL {_plain('filter', "orders WHERE o_orderstatus <> 'F'")} UNION ALL {_plain('filter', 'd')}
  UNION ALL {_plain('unknown', 'd')}
  UNION ALL SELECT 'history', * FROM r""")
def dispatch_by_load_type(spark, sf):
    """The load operator follows from load type and SCD type; unknown types mean a full replace. All rows of each."""
    orders, delta = table(spark, sf, "orders").select(*_COLS), orders_delta(spark, sf).select(*_COLS)
    out = None
    for name, load, scd in (("full", "full", 0), ("append", "incremental", 0), ("upsert", "incremental", 7),
                            ("filter", "filter", 0), ("history", "incremental", 2), ("unknown", "mirror", 1)):
        target = with_history(orders, "2023-01-01") if name == "history" else orders
        rows = merge.apply_load(target, delta, load, scd, ["o_orderkey"], "2024-01-01 00:00:00", "o_orderstatus = 'F'")
        if name != "history":
            rows = with_history(rows, None).withColumn("is_current", F.lit(None).cast("boolean"))
        part = rows.select(F.lit(name).alias("load"), *_COLS, "is_current", "eff_start_date", "eff_end_date")
        out = part if out is None else out.unionByName(part)
    return out


@check(f"""WITH {_DELTA} SELECT o_orderkey, o_orderdate, coalesce(d.price, o_totalprice) AS o_totalprice FROM orders
          LEFT JOIN (SELECT o_orderkey AS k, o_totalprice AS price FROM delta WHERE o_orderkey < 1000000000) d
            ON o_orderkey = k
          UNION ALL SELECT o_orderkey, o_orderdate, o_totalprice FROM delta WHERE o_orderkey >= 1000000000""")
def upsert_by_month(spark, sf):
    """A target cut by month: the load rewrites the months of its rows."""
    columns = ["o_orderkey", "o_orderdate", "o_totalprice"]
    orders, folder = table(spark, sf, "orders").select(*columns), workspace(spark, "work")
    orders_delta(spark, sf).select(*columns).write.parquet(folder)
    target = Target(spark, workspace(spark, "orders")).create(
        target_schema(column_metadata(orders)), ["o_orderkey", "o_orderdate"], 1, "o_orderdate")
    target.append(orders)
    old = {s for s in target._load()["segments"]}
    target.upsert(spark.read.schema(orders.schema).parquet(folder))
    kept = old & set(target._load()["segments"])
    assert len(kept) >= len({s.slice for s in old if s.slice < 2000 * 12 + 1})  # months before the changes
    return target.read()
