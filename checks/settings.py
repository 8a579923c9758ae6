"""Job settings."""

from pyspark.sql import functions as F

from checks.common import LEDGER, check, ledger, table
from tidemark.operators.ledger import next_batch_id
from tidemark.plans import reports
from tidemark.session import workspace
from tidemark.sources import config as settings

# One settings row per customer, with gaps where defaults apply.
_RAW = """raw AS (
  SELECT CASE WHEN c_nationkey < 12 THEN 'SALES' ELSE 'CRM' END AS source_db,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN 'app' END AS source_schema, c_name AS source_table,
    CASE WHEN c_nationkey > 20 THEN 'LAKE' END AS target_db, CAST(NULL AS VARCHAR) AS target_schema,
    upper(c_name) AS target_table, 'id, part' AS primary_key,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'full' WHEN 'HOUSEHOLD' THEN 'incremental' WHEN 'MACHINERY' THEN 'filter' END
      AS load_type, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'updated_at, created_at' END AS cdc_columns,
    CASE WHEN c_nationkey < 5 THEN 'id' END AS cdc_type, CASE WHEN c_nationkey < 20 THEN c_nationkey END AS scd_type,
    CASE WHEN c_acctbal > 5000 THEN 'ingest' WHEN c_acctbal > 2000 THEN 'export' END AS execution_mode,
    CASE WHEN c_nationkey > 3 THEN ',' END AS delimiter, CAST(NULL AS VARCHAR) AS filter_condition,
    CASE WHEN c_nationkey > 3 THEN 'Y' END AS trim, CAST(NULL AS VARCHAR) AS encryption_columns,
    CAST(NULL AS VARCHAR) AS custom_sql, '/stage/' || c_name AS cloud_path, CAST(NULL AS VARCHAR) AS warehouse_name,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal > 0 END AS active FROM customer)"""
CONFIG = f"""{_RAW}, config AS (
  SELECT source_db, coalesce(source_schema, 'dbo') AS source_schema, source_table,
    coalesce(target_db, 'ANALYTICS') AS target_db, coalesce(target_schema, 'PUBLIC') AS target_schema, target_table,
    primary_key, coalesce(upper(load_type), 'FULL') AS load_type, cdc_columns,
    coalesce(upper(cdc_type), 'TIMESTAMP') AS cdc_type, coalesce(scd_type, 0) AS scd_type,
    CASE WHEN upper(execution_mode) = 'INGEST' THEN 'LOAD' ELSE coalesce(upper(execution_mode), 'FULL') END
      AS execution_mode, coalesce(delimiter, '|') AS delimiter, filter_condition, coalesce(trim, 'N') AS trim,
    encryption_columns, custom_sql, cloud_path, coalesce(warehouse_name, 'COMPUTE_WH') AS warehouse_name,
    CASE WHEN active THEN 'Y' ELSE 'N' END AS enabled FROM raw)"""


def raw(spark, sf):
    c, none = table(spark, sf, "customer"), F.lit(None).cast("string")
    segment, nation, balance = F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal")
    return c.select(
        F.when(nation < 12, "SALES").otherwise("CRM").alias("source_db"),
        F.when(segment != "BUILDING", "app").alias("source_schema"), F.col("c_name").alias("source_table"),
        F.when(nation > 20, "LAKE").alias("target_db"), none.alias("target_schema"),
        F.upper("c_name").alias("target_table"), F.lit("id, part").alias("primary_key"),
        F.when(segment == "BUILDING", "full").when(segment == "HOUSEHOLD", "incremental")
        .when(segment == "MACHINERY", "filter").alias("load_type"),
        F.when(segment == "HOUSEHOLD", "updated_at, created_at").alias("cdc_columns"),
        F.when(nation < 5, "id").alias("cdc_type"), F.when(nation < 20, nation).alias("scd_type"),
        F.when(balance > 5000, "ingest").when(balance > 2000, "export").alias("execution_mode"),
        F.when(nation > 3, ",").alias("delimiter"), none.alias("filter_condition"),
        F.when(nation > 3, "Y").alias("trim"), none.alias("encryption_columns"), none.alias("custom_sql"),
        F.concat(F.lit("/stage/"), F.col("c_name")).alias("cloud_path"), none.alias("warehouse_name"),
        F.when(segment != "MACHINERY", balance > 0).alias("active"))


def config(spark, sf):
    return settings.normalise(raw(spark, sf))


@check(f"WITH {CONFIG} SELECT * FROM config")
def config_normalise(spark, sf):
    return config(spark, sf)


@check(f"WITH {CONFIG} SELECT * FROM config")
def config_round_trip(spark, sf):
    """Settings saved in one overwrite, twice, and read back."""
    folder = workspace(spark, "config")
    settings.save_config(raw(spark, sf), folder)
    settings.save_config(raw(spark, sf), folder)
    return spark.read.parquet(folder)


@check(f"WITH {CONFIG} SELECT * FROM config")
def config_from_json(spark, sf):
    """Settings files in JSON, one for every nation of the customers, read as one settings table."""
    folder = workspace(spark, "config")
    rows = raw(spark, sf)
    nation = table(spark, sf, "customer").select(F.col("c_name").alias("source_table"), "c_nationkey")
    files = rows.join(nation, "source_table").groupBy("c_nationkey").agg(
        F.to_json(F.struct(F.collect_list(F.struct(*rows.columns)).alias("tables"))).alias("value"))
    files.write.partitionBy("c_nationkey").text(folder)
    return settings.normalise(settings.read_config(spark, folder)).drop("slices", "partition_column", "allow_history_loss")


@check(f"""WITH {LEDGER}, {CONFIG} SELECT config.* REPLACE ('LOAD' AS execution_mode),
            (SELECT max(batch_id) + 1 FROM ledger) AS batch_id FROM config
          WHERE enabled = 'Y' AND source_db = 'SALES' AND source_schema = 'app'""")
def config_enabled_jobs(spark, sf):
    return settings.enabled_jobs(config(spark, sf), next_batch_id(ledger(spark, sf)), "load", "SALES", "app")


@check(f"""WITH {CONFIG} SELECT count(*) AS total, count(*) FILTER (WHERE enabled = 'Y') AS active,
            count(*) FILTER (WHERE enabled = 'N') AS inactive,
            count(*) FILTER (WHERE load_type = 'INCREMENTAL') AS incremental FROM config""")
def config_kpis(spark, sf):
    return reports.config_kpis(config(spark, sf))


@check(f"""WITH {CONFIG} SELECT source_db || '.' || source_schema || '.' || source_table AS source,
            target_db || '.' || target_schema || '.' || target_table AS target, load_type, scd_type, cdc_columns,
            cdc_type, primary_key, enabled FROM config""")
def config_overview(spark, sf):
    return settings.settings_view(config(spark, sf))
