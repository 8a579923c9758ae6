"""The stage: export, typed read, rejects, inventory, archive."""

from pyspark.sql import functions as F

from checks.common import check, table
from tidemark.functions.columns import quoted
from tidemark.functions.types import ColumnMeta, column_metadata, target_schema
from tidemark.sources import staged
from tidemark.session import workspace


def _round_trip(spark, rows, schema=None, delimiter=None):
    schema = schema or target_schema(column_metadata(rows))
    folder = workspace(spark, "stage")
    staged.write_staged(rows, folder, delimiter)
    text = staged.read_text(spark, folder, schema, delimiter)
    work, _, _ = staged.materialise(staged.check_rows(text, schema), schema, workspace(spark, "work"))
    return work.drop("_file")


@check("SELECT * FROM customer")
def stage_round_trip(spark, sf):
    return _round_trip(spark, table(spark, sf, "customer"))


@check("SELECT * FROM lineitem")
def stage_round_trip_comma(spark, sf):
    return _round_trip(spark, table(spark, sf, "lineitem"), delimiter=",")


@check("""SELECT doc_id, CASE WHEN text NOT IN ('', 'NULL') THEN text END AS text, lang, source, n_chars
          FROM documents""")
def stage_quoting(spark, sf):
    """Texts with newlines, quotes and delimiters come back whole."""
    return _round_trip(spark, table(spark, sf, "documents"))


@check("""SELECT c_custkey, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') THEN c_mktsegment
            END AS segment FROM customer""")
def stage_null_markers(spark, sf):
    """The text NULL, the empty string and NULL itself all load as NULL."""
    marked = (F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_mktsegment") == "HOUSEHOLD", "NULL")
              .when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")))
    return _round_trip(spark, table(spark, sf, "customer").select("c_custkey", marked.alias("segment")))


@check("""SELECT doc_id, '"' || replace(coalesce(text, ''), '"', '""') || '"' AS text,
            '"' || coalesce(lang, '') || '"' AS lang FROM (SELECT '"' || doc_id || '"' AS doc_id, text, lang
            FROM documents)""")
def quoted_export(spark, sf):
    return quoted(table(spark, sf, "documents").select("doc_id", "text", "lang"))


LINE_TYPES = [
    ColumnMeta("l_orderkey", "bigint", nullable=False), ColumnMeta("l_linenumber", "tinyint", nullable=False),
    ColumnMeta("l_partkey", "int"), ColumnMeta("l_quantity", "decimal", precision=15, scale=2),
    ColumnMeta("l_extendedprice", "money"), ColumnMeta("l_discount", "float"), ColumnMeta("l_tax", "smallmoney"),
    ColumnMeta("l_returnflag", "char", 1), ColumnMeta("l_linestatus", "uniqueidentifier"),
    ColumnMeta("l_shipdate", "date"), ColumnMeta("shipped_at", "datetime2"), ColumnMeta("open", "bit")]


@check("""SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber, CAST(l_partkey AS INTEGER) AS l_partkey,
            CAST(l_quantity AS DECIMAL(15,2)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(19,4)) AS l_extendedprice,
            l_discount, CAST(l_tax AS DECIMAL(10,4)) AS l_tax, l_returnflag, l_linestatus,
            CAST(l_shipdate AS DATE) AS l_shipdate, l_shipdate AS shipped_at, l_linestatus = 'O' AS open FROM lineitem""")
def typed_load(spark, sf):
    """Staged text to the target types of the source columns."""
    lines = table(spark, sf, "lineitem").withColumns({
        "shipped_at": F.col("l_shipdate"), "l_shipdate": F.col("l_shipdate").cast("date"),
        "open": F.when(F.col("l_linestatus") == "O", "1").otherwise("0")})
    return _round_trip(spark, lines.select(*[c.name for c in LINE_TYPES]), target_schema(LINE_TYPES))


@check("SELECT p_partkey, p_name FROM part WHERE length(p_name) <= 10")
def varchar_limit(spark, sf):
    """Texts longer than the column keep their row out."""
    schema = target_schema([ColumnMeta("p_partkey", "bigint"), ColumnMeta("p_name", "varchar", 10)])
    return _round_trip(spark, table(spark, sf, "part").select("p_partkey", "p_name"), schema)


BROKEN_TYPES = [ColumnMeta("o_orderkey", "bigint", nullable=False), ColumnMeta("o_custkey", "int"),
                ColumnMeta("o_orderstatus", "varchar", 1), ColumnMeta("o_totalprice", "decimal", precision=12, scale=2),
                ColumnMeta("o_orderdate", "datetime2"), ColumnMeta("o_orderpriority", "varchar", 20)]


def _broken(spark, sf):
    """All orders as staged lines, some of them broken by rule."""
    o, line = table(spark, sf, "orders"), F.col
    urgent, high, medium = (line("o_orderpriority") == p for p in ("1-URGENT", "2-HIGH", "3-MEDIUM"))
    low, status = line("o_orderpriority") == "5-LOW", line("o_orderstatus")
    fields = [F.when(low & (status == "F"), "NULL").otherwise(line("o_orderkey").cast("string")),
              line("o_custkey").cast("string"), F.when(medium, "LONG").otherwise(status),
              F.when(high, "abc").otherwise(line("o_totalprice").cast("decimal(12,2)").cast("string")),
              line("o_orderdate").cast("string")]
    short = F.concat_ws("|", *fields)
    full = F.concat_ws("|", short, "o_orderpriority")
    text = F.when(urgent, short).when(low & (status == "O"), F.concat(full, F.lit("|more"))).otherwise(full)
    folder = workspace(spark, "broken")
    o.select(text.alias("value")).write.option("compression", "gzip").text(folder)
    schema = target_schema(BROKEN_TYPES)
    return staged.check_rows(staged.read_text(spark, folder, schema), schema), schema


@check("""SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
            CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, o_orderpriority FROM orders
          WHERE o_orderpriority = '4-NOT SPECIFIED' OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')""")
def stage_good_rows(spark, sf):
    checked, schema = _broken(spark, sf)
    return staged.good_rows(checked, schema)


@check("""SELECT CASE WHEN o_orderpriority = '1-URGENT' OR o_orderpriority = '5-LOW' AND o_orderstatus = 'O'
              THEN 'field count' WHEN o_orderpriority = '2-HIGH' THEN 'bad value: o_totalprice'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'too long: o_orderstatus' ELSE 'missing: o_orderkey' END AS reason,
            count(*) AS n FROM orders
          WHERE NOT (o_orderpriority = '4-NOT SPECIFIED' OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'P'))
          GROUP BY ALL""")
def stage_rejects(spark, sf):
    checked, _ = _broken(spark, sf)
    return staged.rejects(checked).groupBy(F.col("_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@check("""SELECT count(*) AS rows_read, count(*) FILTER (WHERE ok) AS rows_loaded,
            count(*) FILTER (WHERE NOT ok) AS rows_rejected FROM (SELECT o_orderpriority = '4-NOT SPECIFIED'
              OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') AS ok FROM orders)""")
def stage_counts(spark, sf):
    """Counts of the work table, written in one pass over the staged text."""
    checked, schema = _broken(spark, sf)
    work, bad, _ = staged.materialise(checked, schema, workspace(spark, "work"))
    both = work.select(F.lit(True).alias("ok")).unionByName(bad.select(F.lit(False).alias("ok")))
    return both.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if("ok").alias("rows_loaded"),
                    F.count_if(~F.col("ok")).alias("rows_rejected"))


def _job(name):
    return {"target_db": "ANALYTICS", "target_schema": "PUBLIC", "target_table": name}


@check("""SELECT 'CUSTOMER' AS table_name, CAST(7 AS BIGINT) AS batch_id, CAST(4 AS BIGINT) AS n_files, true AS has_data
          UNION ALL SELECT 'ORDERS', 7, 3, true UNION ALL SELECT 'ORDERS', 8, 3, true""")
def stage_inventory(spark, sf):
    """Staged files per table and batch."""
    stage = workspace(spark, "stage")
    for name, batch, files in (("customer", 7, 4), ("orders", 7, 3), ("orders", 8, 3)):
        staged.write_staged(table(spark, sf, name), staged.batch_folder(stage, _job(name.upper()), batch), files=files)
    return staged.inventory(spark, stage).groupBy("table_name", "batch_id").agg(
        F.count(F.lit(1)).alias("n_files"), (F.sum("length") > 0).alias("has_data"))


@check("""SELECT 'sales.a.orders' AS source, CAST(7 AS BIGINT) AS batch_id, o_orderkey, o_totalprice FROM orders
          UNION ALL SELECT 'sales.a.orders', 8, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
          UNION ALL SELECT 'sales.b.orders', 7, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'""")
def archive_by_batch(spark, sf):
    """Loaded batches are moved to the dated archive and can be read there; equal table names of two schemas lie apart."""
    stage, place = workspace(spark, "stage"), workspace(spark, "archive")
    orders = table(spark, sf, "orders")
    parts = (("a", 7, orders), ("a", 8, orders.where("o_orderstatus = 'F'")), ("b", 7, orders.where("o_orderstatus = 'O'")))
    for schema_name, batch, rows in parts:
        job = {**_job("ORDERS"), "source_db": "sales", "source_schema": schema_name, "source_table": "orders"}
        staged.write_staged(rows, staged.batch_folder(stage, job, batch))
        staged.archive(spark, stage, job, batch, place, "20240201")
        assert staged.pending_batches(spark, stage, job) == []
    schema = target_schema(column_metadata(orders))
    base = f"{place}/dt=20240201/ANALYTICS/PUBLIC/ORDERS"
    text = staged.read_text(spark, base, schema, base=base)
    return staged.check_rows(text, schema).select("source", F.col("batch_id").cast("long"), "o_orderkey", "o_totalprice")


@check("""SELECT status, n, (SELECT CAST(ceil(count(*) / (count(*) // 10)) AS BIGINT) FROM orders) AS n_files
          FROM (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL)""")
def stage_small_files(spark, sf):
    """Files cut by row count hold every row once, and there are as many as the cut asks for."""
    orders = table(spark, sf, "orders")
    folder = workspace(spark, "stage")
    staged.write_staged(orders, folder, files=1, rows_per_file=max(1, orders.count() // 10))
    schema = target_schema(column_metadata(orders))
    text = staged.read_text(spark, folder, schema)
    files = staged.inventory(spark, folder).count()
    return text.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "n_files", F.lit(files).cast("long"))


@check("""SELECT lang, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, true AS cut FROM documents GROUP BY ALL""")
def stage_files_by_bytes(spark, sf):
    """Files are cut by bytes of text: no row is lost, and there are several files of about the size asked for."""
    docs = table(spark, sf, "documents")
    folder = workspace(spark, "stage")
    total = staged.as_text(docs).agg(F.sum(staged.text_bytes(staged.as_text(docs)))).first()[0]
    staged.write_staged(docs, folder, files=1, file_bytes=total // 5)
    schema = target_schema(column_metadata(docs))
    files = staged.inventory(spark, folder).count()
    return staged.read_text(spark, folder, schema).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).withColumn("cut", F.lit(4 <= files <= 7))


@check("""SELECT CASE WHEN page_id % 3 = 0 THEN 'bad value: body' ELSE 'good' END AS reason, count(*) AS n
          FROM pages GROUP BY ALL""")
def stage_rejects_xml(spark, sf):
    """XML that is not well formed keeps its own row out; the others load."""
    pages = table(spark, sf, "pages")
    text = F.regexp_replace(F.coalesce("html", F.lit("")), r"[^\p{L}\p{N} ]", " ")
    good = F.concat(F.lit("<page><url>"), F.regexp_replace(F.coalesce("url", F.lit("")), r"[<>&]", " "), F.lit("</url><text>"),
                    text, F.lit("</text></page>"))
    bad = F.concat(F.lit("<page><url>"), text, F.lit("</text>"))
    rows = pages.select("page_id", F.when(F.col("page_id") % 3 == 0, bad).otherwise(good).alias("body"))
    folder = workspace(spark, "stage")
    staged.write_staged(rows, folder)
    schema = target_schema([ColumnMeta("page_id", "bigint"), ColumnMeta("body", "xml")])
    checked = staged.check_rows(staged.read_text(spark, folder, schema), schema)
    return checked.groupBy(F.coalesce("_reason", F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
