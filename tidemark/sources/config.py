"""Job settings: one row per table to replicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_TEXT = ["source_db", "source_schema", "source_table", "target_db", "target_schema", "target_table",
         "primary_key", "load_type", "cdc_columns", "cdc_type"]
_TEXT_2 = ["execution_mode", "delimiter", "filter_condition", "trim", "encryption_columns", "custom_sql",
           "cloud_path", "warehouse_name"]

CONFIG_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in _TEXT] + [T.StructField("scd_type", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in _TEXT_2] + [T.StructField("active", T.BooleanType())])
# Settings of this library's targets, which a settings table may leave out.
TARGET_FIELDS = [T.StructField("slices", T.IntegerType()), T.StructField("partition_column", T.StringType()),
                 T.StructField("allow_history_loss", T.BooleanType())]

# Defaults of the job settings.
DEFAULTS = {
    "source_schema": "dbo",
    "target_db": "ANALYTICS",
    "target_schema": "PUBLIC",
    "scd_type": 0,
    "load_type": "FULL",
    "delimiter": "|",
    "trim": "N",
    "execution_mode": "FULL",
    "cdc_type": "TIMESTAMP",
    "warehouse_name": "COMPUTE_WH",
}
_UPPER = ["load_type", "execution_mode", "cdc_type"]


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Job rows from a JSON settings file ``{"tables": [...]}``."""
    schema = T.StructType([*CONFIG_SCHEMA, *TARGET_FIELDS])
    wrapped = T.StructType([T.StructField("tables", T.ArrayType(schema))])
    return (spark.read.schema(wrapped).option("multiLine", "true").json(path)
            .select(F.inline("tables")))


def _filled(name: str) -> Column:
    value = F.col(name)
    if name in _UPPER:
        value = F.upper(value)
    if name in DEFAULTS:
        value = F.coalesce(value, F.lit(DEFAULTS[name]).cast(CONFIG_SCHEMA[name].dataType))
    return value.alias(name)


def normalise(config: DataFrame) -> DataFrame:
    """Defaults filled in, fixed words in upper case, ``enabled`` Y or N from ``active``.

    The older mode name INGEST is read as LOAD.
    """
    names = [n for n in CONFIG_SCHEMA.names if n != "active"]
    own = [F.col(f.name) for f in TARGET_FIELDS if f.name in config.columns]
    out = config.select(*[_filled(n) for n in names], *own,
                        F.when(F.coalesce("active", F.lit(False)), "Y").otherwise("N").alias("enabled"))
    mode = F.when(F.col("execution_mode") == "INGEST", "LOAD").otherwise(F.col("execution_mode"))
    return out.withColumn("execution_mode", mode)


def with_job_ids(config: DataFrame) -> DataFrame:
    """Add a ``job_id`` that depends on the table only and so stays the same over syncs."""
    return config.withColumn(
        "job_id", F.abs(F.xxhash64("source_db", "source_schema", "source_table", "target_table")))


def save_config(config: DataFrame, path: str) -> None:
    """Write the normalised settings in one overwrite."""
    normalise(config).write.mode("overwrite").parquet(path)


def enabled_jobs(config: DataFrame, batch: DataFrame | None = None, mode: str | None = None,
                 source_db: str | None = None, source_schema: str | None = None,
                 source_table: str | None = None) -> DataFrame:
    """Enabled jobs, optionally of one table and with another mode, plus the batch id.

    ``batch`` is the one-row result of ``next_batch_id``.
    """
    jobs = config.where("enabled = 'Y'")
    for name, wanted in (("source_db", source_db), ("source_schema", source_schema),
                         ("source_table", source_table)):
        if wanted is not None:
            jobs = jobs.where(F.col(name) == wanted)
    if mode:
        jobs = jobs.withColumn("execution_mode", F.lit(mode.upper()))
    return jobs.withColumn("batch_id", batch.scalar()) if batch is not None else jobs


def settings_view(config: DataFrame) -> DataFrame:
    """The settings overview: full names of both sides and how each table is loaded."""
    return config.select(
        F.concat_ws(".", "source_db", "source_schema", "source_table").alias("source"),
        F.concat_ws(".", "target_db", "target_schema", "target_table").alias("target"),
        "load_type", "scd_type", "cdc_columns", "cdc_type", "primary_key", "enabled")
