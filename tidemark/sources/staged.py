"""The stage: delimited, quoted, compressed files without a header.

Files are written by Spark below ``<stage>/<db>/<schema>/<table>/batch_id=<n>/`` and read back
typed. Rows that do not fit the target go to a reject table with the reason; the load
goes on.
"""

from __future__ import annotations

import json
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark import fs
from tidemark.functions.columns import as_text
from tidemark.functions.types import from_text
from tidemark.session import at_most, workspace

# Texts that mean NULL in a staged file.
NULL_MARKERS = ["NULL", ""]
DELIMITER = "|"
# One gzip file is one task, so files are cut at about this many bytes of text before compression.
FILE_BYTES = 256 << 20
# Rows whose text is measured to find how many make a file; the cut moves no row, only file ends.
MEASURED_ROWS = 1000
# Staged files are dealt out to tasks by so many compressed bytes, larger ones alone: they are several times as much text.
TASK_BYTES = 16 << 20
# A work table's files hold at most so many rows.
WORK_ROWS = 250_000


class StageCounts(NamedTuple):
    rows_read: int
    rows_loaded: int
    rows_rejected: int


def source_name(job: dict) -> str:
    """The source of a job as one name: what two sources of one target are told apart by."""
    parts = [job.get(n) or "" for n in ("source_db", "source_schema", "source_table")]
    return "source=" + ".".join(p.replace("/", "_") for p in parts)


def table_folder(stage: str, job: dict) -> str:
    """Where a job's batches wait: below its own stage path, if it names one, else below the common one."""
    return "/".join([(job.get("cloud_path") or stage).rstrip("/"), job.get("target_db") or "",
                     job.get("target_schema") or "", job["target_table"], source_name(job)])


def batch_folder(stage: str, job: dict, batch_id: int) -> str:
    return f"{table_folder(stage, job)}/batch_id={batch_id}"


def csv_options(delimiter: str | None) -> dict[str, str]:
    """Options that both ends of the stage share."""
    return {"sep": delimiter or DELIMITER, "quote": '"', "escape": '"', "encoding": "UTF-8",
            "header": "false", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "nullValue": "", "emptyValue": "", "lineSep": "\n"}


def text_bytes(rows: DataFrame) -> Column:
    """Bytes of a row as staged text, with quotes and delimiters."""
    size = F.lit(3 * len(rows.columns))
    for name in rows.columns:
        size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    return size


def rows_for(rows: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """How many rows make a file of so many bytes, by the mean of the first rows."""
    text = as_text(rows.limit(MEASURED_ROWS))
    mean = text.agg(F.avg(text_bytes(text))).first()[0]
    return max(1, int(file_bytes / mean)) if mean else 1


def dealt(rows: DataFrame, files: int, rows_per_file: int | None, file_bytes: int) -> tuple[DataFrame, int]:
    """Written rows dealt out in turn to as many tasks as there will be files, and the rows a file may hold.

    There are as many files as the cut asks for, and at least ``files``; they differ by one row at most. Each scan partition
    goes on where the one before it stops, so all that meets in one place are the partitions' row counts.
    """
    text = as_text(rows)
    per = text.select(F.spark_partition_id().alias("p"), text_bytes(text).alias("b")).groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).collect()
    n, size = sum(r["n"] for r in per), sum(r["b"] for r in per)
    wanted = -(-n // rows_per_file) if rows_per_file else -(-size // max(1, file_bytes))
    files = max(files, min(n, wanted))
    starts, at = [0] * (1 + max((r["p"] for r in per), default=0)), 0
    for r in sorted(per):
        starts[r["p"]], at = at % files, at + r["n"]
    nth = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + F.coalesce(F.get(F.lit(starts), F.spark_partition_id()), F.lit(0))
    numbered = rows.withColumn("_file_no", (nth % files).cast("int"))
    return numbered.repartitionById(files, F.col("_file_no")).drop("_file_no"), rows_per_file or max(1, -(-n // files))


def _beside(folder: str, kind: str) -> str:
    """A small file about a batch, beside its folder: a batch's folder holds its data only."""
    parent, name = folder.rstrip("/").rsplit("/", 1)
    return f"{parent}/{kind}/{name}.json"


def exported_schema(spark: SparkSession, folder: str) -> T.StructType | None:
    """The columns of a batch in the order of its files; None for a batch of an export that did not say."""
    text = fs.read_text(spark, _beside(folder, "_columns"))
    return T.StructType.fromJson(json.loads(text)) if text else None


def announce(spark: SparkSession, folder: str) -> None:
    """Say that a batch is finished, for streams: a marker beside the batches, which carries its folder."""
    batch = folder.rstrip("/").rsplit("batch_id=", 1)
    if len(batch) == 2 and batch[1].isdigit():
        fs.write_text(spark, _beside(folder, "finished"), json.dumps({"batch_id": int(batch[1])}))


def announce_missing(spark: SparkSession, stage: str, job: dict) -> None:
    """Announce finished batches whose export died before it could."""
    known = set(fs.children(spark, f"{table_folder(stage, job)}/finished"))
    for batch in pending_batches(spark, stage, job):
        if f"batch_id={batch}.json" not in known:
            announce(spark, batch_folder(stage, job, batch))


def write_staged(rows: DataFrame, folder: str, delimiter: str | None = None, files: int | None = None,
                 rows_per_file: int | None = None, highest: str | None = None,
                 file_bytes: int = FILE_BYTES, columns: T.StructType | None = None, like: DataFrame | None = None) -> tuple[int, int | None]:
    """Export rows as text, every value quoted. ``columns`` says what they are called where the rows' own names are numbers only.
    ``like``: rows about as long, such as those a costly query reads; the cut is measured on them, and the query runs once.

    Returns how many rows there were and the highest value of the id column ``highest``, both
    taken from the very rows that were written. A complete export is never overwritten.
    """
    if fs.exists(rows.sparkSession, f"{folder}/_SUCCESS"):
        raise FileExistsError(f"{folder} holds an export already")
    # before the data, so that a finished batch always says which columns its files hold
    fs.write_text(rows.sparkSession, _beside(folder, "_columns"), json.dumps((columns or rows.schema).jsonValue()))
    seen = Observation()
    copy = workspace(rows.sparkSession, "export")
    if files:
        # written once: how many rows there are and where each goes then follow from the same rows, and no query runs twice
        kinds = rows.schema
        plain = rows.toDF(*[f"_c{i}" for i in range(len(kinds))])
        plain.select(*[F.col(f.name).cast("string" if isinstance(f.dataType, T.NullType) else f.dataType) for f in plain.schema]).write.parquet(copy)
        rows, rows_per_file = dealt(rows.sparkSession.read.parquet(copy).toDF(*kinds.names), files, rows_per_file, file_bytes)
    else:
        rows_per_file = rows_per_file or rows_for(rows if like is None else like, file_bytes)
    top = F.max(F.col(highest).try_cast("long")) if highest else F.max(F.lit(None).cast("long"))
    # Observed last, in the tasks that write, so a repeated task is not counted twice.
    (as_text(rows).observe(seen, F.count(F.lit(1)).alias("n"), top.alias("top"))
     .write.mode("overwrite").options(**csv_options(delimiter)).option("quoteAll", "true")
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", rows_per_file).csv(folder))
    fs.remove(rows.sparkSession, copy)
    announce(rows.sparkSession, folder)
    return seen.get["n"], seen.get["top"]


def text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema]
                        + [T.StructField("_bad", T.StringType())])


def read_options(delimiter: str | None) -> dict[str, str]:
    # multiLine keeps newlines inside quotes; columnPruning off keeps the field count checked.
    return {**csv_options(delimiter), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad",
            "multiLine": "true", "columnPruning": "false"}


def read_text(spark: SparkSession, folders: list[str] | str, schema: T.StructType,
              delimiter: str | None = None, base: str | None = None) -> DataFrame:
    """Staged rows as text in target column order, plus ``_bad`` and the file they came from."""
    reader = spark.read.schema(text_schema(schema)).options(**read_options(delimiter))
    if base:
        reader = reader.option("basePath", base)
    rows = reader.csv(folders)
    return rows.withColumn("_file", F.col("_metadata.file_path"))


def read_by_name(spark: SparkSession, folders: list[str], schema: T.StructType, delimiter: str | None = None,
                 base: str | None = None) -> DataFrame:
    """Like ``read_text``, but every value goes to the column of its name, whatever the order in its batch; columns that a batch
    does not have are NULL. Batches that do not say which columns they hold are read by position."""
    by_columns: dict[tuple, list[str]] = {}
    for folder in folders:
        said = exported_schema(spark, folder)
        by_columns.setdefault(tuple(said.names) if said else tuple(schema.names), []).append(folder)
    parts = []
    for names, group in by_columns.items():
        held = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
        rows = read_text(spark, group, held, delimiter, base)
        place = {n.lower(): f"_c{i}" for i, n in enumerate(names)}
        extra = [c for c in rows.columns if c not in held.names and c != "_bad"]
        parts.append(rows.select(*[(F.col(place[f.name.lower()]) if f.name.lower() in place else F.lit(None).cast("string")).alias(f.name)
                                   for f in schema], "_bad", *extra))
    return reduce(DataFrame.unionByName, parts)


def _without_markers(name: str) -> Column:
    value = F.col(f"`{name}`")
    return F.when(~value.isin(NULL_MARKERS), value)


def _reason(field: T.StructField, typed: Column, text: Column) -> list[Column]:
    """Why one value keeps its row out; NULL where nothing is wrong."""
    checks = []
    if not isinstance(field.dataType, T.StringType):
        checks.append(F.when(text.isNotNull() & typed.isNull(), F.lit(f"bad value: {field.name}")))
    limit = field.metadata.get("max_length")
    if limit:
        size = F.length(typed) if isinstance(field.dataType, T.BinaryType) else F.char_length(text)
        checks.append(F.when(size > limit, F.lit(f"too long: {field.name}")))
    if not field.nullable:
        checks.append(F.when(text.isNull(), F.lit(f"missing: {field.name}")))
    return checks


def check_rows(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns plus ``_reason`` (NULL for a good row) and ``_raw`` (rejected rows only).

    Three projections one on the other: the text without NULL markers, its typed values beside
    it, and the checks on both. Each value is so parsed once, however often the checks use it.
    """
    extra = [c for c in text.columns if c not in schema.names and c != "_bad"]
    clean = text.select(*[_without_markers(f.name).alias(f"_text_{i}") for i, f in enumerate(schema)], "_bad", *extra)
    parsed = [(f, f"_text_{i}") if isinstance(f.dataType, T.StringType) else (f, f"_typed_{i}")
              for i, f in enumerate(schema)]
    typed = clean.withColumns({name: from_text(F.col(f"_text_{i}"), f.dataType)
                               for i, (f, name) in enumerate(parsed) if name.startswith("_typed_")})
    reasons = [F.when(F.col("_bad").isNotNull(), F.lit("field count"))]
    for i, (field, name) in enumerate(parsed):
        reasons += _reason(field, F.col(name), F.col(f"_text_{i}"))
    raw = F.coalesce("_bad", F.to_json(F.struct(*[F.col(f"_text_{i}").alias(f.name) for i, f in enumerate(schema)])))
    marked = typed.withColumn("_reason", F.coalesce(*reasons, F.lit(None).cast("string")))
    return marked.select(*[F.col(name).alias(f.name) for f, name in parsed], "_reason",
                         F.when(F.col("_reason").isNotNull(), raw).alias("_raw"), *extra)


def good_rows(checked: DataFrame, schema: T.StructType) -> DataFrame:
    return checked.where("_reason is null").select(*schema.names)


def rejects(checked: DataFrame) -> DataFrame:
    return checked.where("_reason is not null").select(
        "_reason", "_raw", *[c for c in checked.columns if c in ("_file", "batch_id")])


def materialise(checked: DataFrame, schema: T.StructType, folder: str) -> tuple[DataFrame, DataFrame, StageCounts]:
    """Write the work table: good rows and rejects, the staged text parsed once.

    Returns work rows, rejects and their counts, all read from the written table. Both lie in the same files, told apart by
    their reason: parts of their own would have Spark sort all rows of a task. One task writes the rows of a whole
    staged file, so its part is cut again, and later steps read it in several tasks. A large file is a task of its own: in
    one with others it would keep the job waiting.
    """
    spark = checked.sparkSession
    extra = [c for c in checked.columns if c not in schema.names]
    fields = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema]
                          + [checked.schema[c] for c in extra])
    with at_most(spark, "spark.sql.files.maxPartitionBytes", TASK_BYTES):
        checked.write.mode("overwrite").option("maxRecordsPerFile", WORK_ROWS).parquet(folder)
    rows = spark.read.schema(fields).parquet(folder)
    work, bad = rows.where("_reason is null"), rows.where("_reason is not null")
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count("_reason").alias("bad")).first()
    loaded, rejected = seen["n"] - seen["bad"], seen["bad"]
    return (work.drop("_reason", "_raw"), bad.select("_reason", "_raw", *[c for c in extra if c in ("_file", "batch_id")]),
            StageCounts(loaded + rejected, loaded, rejected))


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Staged files with their table, batch and size. Contents are not read."""
    # .../<target table>/source=<source>/batch_id=<n>/<file>
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.csv*").load(folder).select("path", "length"))
    return files.select(
        F.regexp_extract("path", r"([^/]+)/source=[^/]*/batch_id=\d+/[^/]+$", 1).alias("table_name"),
        F.regexp_extract("path", r"batch_id=(\d+)/[^/]+$", 1).try_cast("long").alias("batch_id"),
        "path", "length")


def staged_files(spark: SparkSession, folder: str) -> int:
    """How many files wait in a table's folder; 0 for none."""
    if not fs.exists(spark, folder):
        return 0
    return inventory(spark, folder).count()


def pending_batches(spark: SparkSession, stage: str, job: dict) -> list[int]:
    """Batches of a table that wait in the stage, oldest first. A batch whose export died does not count."""
    folder = table_folder(stage, job)
    names = [n for n in fs.children(spark, folder) if n.startswith("batch_id=") and n[9:].isdigit()]
    return sorted(int(n[9:]) for n in names if fs.exists(spark, f"{folder}/{n}/_SUCCESS"))


def archive(spark: SparkSession, stage: str, job: dict, batch_id: int, archive_root: str, day: str) -> str:
    """Move a loaded batch to the dated archive; a rename, no data is copied."""
    place = batch_folder(f"{archive_root.rstrip('/')}/dt={day}", {**job, "cloud_path": None}, batch_id)
    source = batch_folder(stage, job, batch_id)
    if fs.exists(spark, source):
        if fs.exists(spark, place):
            raise FileExistsError(f"{place} is in the archive already")
        fs.move(spark, source, place)
        fs.remove(spark, _beside(source, "finished"))  # it is loaded: no stream needs to hear of it
        if fs.exists(spark, _beside(source, "_columns")):
            fs.move(spark, _beside(source, "_columns"), _beside(place, "_columns"))
    return place
