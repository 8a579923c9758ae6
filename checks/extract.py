"""Extraction: whole tables, filters, change windows, queries."""

from pyspark.sql import functions as F

from checks.common import LEDGER, check, ledger, table
from tidemark.functions.predicates import extract_condition, id_window, time_window
from tidemark.operators import ledger as runs
from tidemark.sources import tables


@check("SELECT * FROM orders")
def full_extract(spark, sf):
    job = {"load_type": "full", "source_table": "orders"}
    return tables.extract(spark, job, tables.parquet_reader(spark, sf), None, None)


@check("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def filter_extract(spark, sf):
    job = {"load_type": "filter", "source_table": "orders",
           "filter_condition": "o_orderstatus = 'F' AND o_totalprice > 100000"}
    return tables.extract(spark, job, tables.parquet_reader(spark, sf), None, None)


@check("SELECT * FROM lineitem")
def filter_extract_empty_condition(spark, sf):
    job = {"load_type": "filter", "source_table": "lineitem", "filter_condition": ""}
    return tables.extract(spark, job, tables.parquet_reader(spark, sf), None, None)


@check("""SELECT o_orderkey, o_custkey, l_linenumber, l_shipdate FROM orders JOIN lineitem ON o_orderkey = l_orderkey
          WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-07-01'""")
def custom_sql_window(spark, sf):
    sql = ("SELECT o_orderkey, o_custkey, l_linenumber, l_shipdate FROM {orders} JOIN {lineitem} "
           "ON o_orderkey = l_orderkey "
           "WHERE l_shipdate >= :extract_start_dttm AND l_shipdate < :extract_end_dttm")
    return tables.run_query(spark, sql, {n: table(spark, sf, n) for n in ("orders", "lineitem")},
                            "1998-01-01 00:00:00", "1999-07-01 00:00:00")


@check("""SELECT CAST(c_custkey AS VARCHAR) AS "COLUMN_1", c_name AS "COLUMN_2", n_name AS "COLUMN_3",
            CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS "COLUMN_4"
          FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def custom_sql_cast_columns(spark, sf):
    job = {"custom_sql": "SELECT c_custkey, c_name AS who, n_name, CAST(c_acctbal AS DECIMAL(12,2)) AS balance "
                         "FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey", "load_type": "full"}
    return tables.extract(spark, job, None, None, None, {n: table(spark, sf, n) for n in ("customer", "nation")})


@check("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-08 06:00:00' AND ts < TIMESTAMP '2024-01-18 00:00:00'")
def cdc_ts_window(spark, sf):
    return tables.select_rows(table(spark, sf, "events"),
                              time_window(["ts"], "2024-01-08 06:00:00", "2024-01-18 00:00:00"))


_TWO_TIMES = """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_orderdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@check(f"""SELECT * FROM ({_TWO_TIMES})
          WHERE (l_shipdate >= TIMESTAMP '1998-03-01' AND l_shipdate < TIMESTAMP '1998-09-01')
             OR (o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-09-01')""")
def cdc_ts_multi_column(spark, sf):
    job = {"load_type": "incremental", "cdc_columns": "l_shipdate, o_orderdate", "cdc_type": "TIMESTAMP"}
    both = (table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.expr("l_orderkey = o_orderkey"))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "o_orderdate"))
    return tables.select_rows(both, extract_condition(job, {"window_end": "1998-03-01 00:00:00"}, "1998-09-01 00:00:00"))


@check("SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' AND o_orderdate >= TIMESTAMP '1900-01-01'")
def cdc_first_run(spark, sf):
    job = {"load_type": "incremental", "cdc_columns": "o_orderdate", "cdc_type": "TIMESTAMP"}
    return tables.select_rows(table(spark, sf, "orders"), extract_condition(job, None, "2000-01-01 00:00:00"))


@check("SELECT * FROM lineitem")
def cdc_no_column_reads_all(spark, sf):
    job = {"load_type": "incremental", "cdc_columns": None}
    return tables.select_rows(table(spark, sf, "lineitem"), extract_condition(job, None, "2000-01-01"))


@check(f"""WITH {LEDGER}, mark AS (SELECT max(max_id) AS last_id FROM ledger WHERE source_table = 'purchase'
            AND final_status = 'SUCCESS' AND execution_mode IN ('FULL', 'EXPORT') AND batch_id < 10015)
          SELECT events.* FROM events, mark WHERE event_id > last_id""")
def cdc_id_window(spark, sf):
    done = ledger(spark, sf).where("batch_id < 10015 and source_table = 'purchase'")
    last = runs.id_watermarks(done).first()["last_id"]
    return table(spark, sf, "events").where(id_window("event_id", last))


@check(f"""WITH {LEDGER} SELECT source_db, source_schema, source_table, max(max_id) AS last_id FROM ledger
          WHERE final_status = 'SUCCESS' AND execution_mode IN ('FULL', 'EXPORT') GROUP BY ALL""")
def cdc_id_watermark(spark, sf):
    return runs.id_watermarks(ledger(spark, sf))


@check("SELECT max(o_orderkey) AS max_id FROM orders")
def max_source_id(spark, sf):
    return tables.max_id(table(spark, sf, "orders"), "o_orderkey")


@check(f"""WITH {LEDGER} SELECT source_db, source_schema, source_table, max(job_start_time) AS watermark FROM ledger
          WHERE final_status = 'SUCCESS' AND execution_mode IN ('FULL', 'EXPORT') GROUP BY ALL""")
def cdc_time_watermark(spark, sf):
    return runs.time_watermarks(ledger(spark, sf))


@check(f"""WITH {LEDGER} SELECT source_db, source_schema, source_table, batch_id, window_start, window_end, max_id
          FROM ledger WHERE final_status = 'SUCCESS' AND execution_mode IN ('FULL', 'EXPORT')
          QUALIFY row_number() OVER (PARTITION BY source_db, source_schema, source_table
                                     ORDER BY batch_id DESC, job_id DESC) = 1""")
def watermark_latest_success(spark, sf):
    return runs.watermarks(ledger(spark, sf))


@check(f"WITH {LEDGER} SELECT coalesce(max(batch_id) + 1, 10000) AS batch_id FROM ledger")
def next_batch_id(spark, sf):
    return runs.next_batch_id(ledger(spark, sf))


@check("""SELECT p_partkey, trim(p_name) AS p_name, trim(p_brand) AS p_brand, trim(p_type) AS p_type, p_size,
            p_retailprice FROM part""")
def trim_columns(spark, sf):
    padded = table(spark, sf, "part").withColumns({
        "p_name": F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")),
        "p_type": F.concat(F.col("p_type"), F.lit("   "))})
    return tables.prepare(padded, {"trim": "Y"})


@check("SELECT c_custkey, c_name, c_mktsegment, true AS hidden FROM customer")
def encrypt_round_trip(spark, sf):
    from tidemark.functions.columns import decrypt
    key = b"0123456789abcdef"
    plain = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    job = {"encryption_columns": "c_name, c_mktsegment"}
    hidden = tables.prepare(plain.withColumn("shown", F.col("c_name")), job, key)
    hidden = hidden.withColumn("hidden", F.col("shown") != F.col("c_name")).drop("shown")
    return decrypt(hidden, ["c_name", "c_mktsegment"], key)
