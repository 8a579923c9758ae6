"""Two-pass external shuffle into shards. Built-in functions only.

Pass 1 scatters whole records uniformly into buckets by a seeded hash of all that names a record (id and text); the
number of buckets follows the bytes, so that a bucket fits in a task's memory. Pass 2 packs each bucket, puts its records
in a defined order, permutes them with Spark's ``shuffle`` (Fisher-Yates) from a fixed seed and writes them. The position
of a record is the number of records in earlier buckets plus its place in its own; shard and slot are the remainder and
the quotient of the position by the number of shards, so that shard counts are at most one apart (law ``rows``).

Each bucket is one partition, and rows reach ``shuffle`` in a defined order:
a task that runs again after the loss of an executor makes the same permutation.

Rows that repeat one id and text have one name. A sketch of fixed size counts names; where far more rows than on average
share a counter, their place in the input is added to their names, so that they spread over the buckets too.

Defined results: a NULL text has no bytes (size 1, CRC 0). An empty table gives an empty result. Rows with a NULL id and rows that
repeat an id and its text very often are scattered by their place in the input. Input columns named shard or slot are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tidemark.llm.common import col, free_name, text_of, without, written
from tidemark.operators.membership import BITS, frequent, may_match

#: Bytes of text in a bucket, on average. A task holds a bucket about three times while it permutes it.
BUCKET_BYTES = 32 << 20
#: Bytes of a column of fixed width, and of a record besides its columns.
FIELD_BYTES, RECORD_BYTES = 8, 16
#: Buckets that are numbered together.
NUMBERED = 4096


def row_bytes(docs: DataFrame) -> Column:
    """Bytes of a record in memory, about: texts by their length, nested values by that of their JSON."""
    size = F.lit(RECORD_BYTES)
    for field in docs.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(col(field.name)), F.lit(0)) + FIELD_BYTES
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(col(field.name)))), F.lit(0))
        else:
            size = size + FIELD_BYTES
    return size


def shuffle_into_shards(docs: DataFrame, n_shards: int = 16, seed: int = 17, id_col: str = "doc_id",
                        text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns of the input, with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0)."""
    docs = without(docs, "shard", "slot")
    total, rows = docs.agg(F.coalesce(F.sum(row_bytes(docs)), F.lit(0)), F.count("*")).first()
    n = max(1, -(-total // bucket_bytes))
    # rows without an id, or with a name that very many rows have: their place in the input stands for it, so that they spread too
    often = free_name(docs, "_often")
    columns = docs.columns
    docs = may_match(docs, frequent(docs, col(id_col), col(text_col), limit=8 + 4 * rows // BITS), col(id_col), col(text_col), flag=often)
    named = [col(id_col), col(text_col), F.when(col(id_col).isNull() | col(often), F.monotonically_increasing_id())]
    bucket, order, rec, pos = (free_name(docs, x) for x in ("_bucket", "_order", "_rec", "_pos"))
    scattered = docs.select(
        F.pmod(F.xxhash64(F.lit(seed), *named), F.lit(n)).cast("int").alias(bucket),
        F.struct(F.xxhash64(F.lit(seed + 1), *named).alias("h"),
                 *[col(c).alias(f"c{i}") for i, c in enumerate(columns)]).alias(rec))
    # the bucket is the number of the partition: a task never holds two of them
    packed = (scattered.repartitionById(n, F.col(bucket)).groupBy(bucket)
              .agg(F.sort_array(F.collect_list(rec)).alias(order)))
    permuted = packed.select(bucket, F.posexplode(F.shuffle(order, seed)).alias(pos, rec))
    placed = written(permuted, "shards-buckets")
    counts = written(placed.groupBy(bucket).agg(F.count("*").alias("n")).select(
        F.col(bucket).alias("_b"), (F.col(bucket) / NUMBERED).cast("int").alias("_g"), "n"), "shards-counts")
    # numbered in two levels: groups of buckets, then the buckets of each
    groups = counts.groupBy("_g").agg(F.sum("n").alias("in_group")).select(
        F.col("_g").alias("_group"), (F.sum("in_group").over(W.orderBy("_g")) - F.col("in_group")).alias("_before"))
    inner = F.sum("n").over(W.partitionBy("_g").orderBy("_b")) - F.col("n")
    # written so that Spark knows its size before it plans the join with the records
    first = written(counts.withColumn("_inner", inner).join(groups, F.col("_g") == F.col("_group")).select(
        "_b", (F.col("_before") + F.col("_inner")).alias("_first")), "shards-offsets")
    at = F.col("_first") + F.col(pos)
    return (placed.join(first, F.col(bucket) == F.col("_b"))
            .select(*[F.col(f"{rec}.c{i}").alias(c) for i, c in enumerate(columns)],
                    (at % n_shards).cast("int").alias("shard"), F.floor(at / n_shards).cast("long").alias("slot")))


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write one folder per shard, its files in slot order; a shard of any size is cut into files of bounded length."""
    piece = F.floor(F.col("slot") / rows_per_file)
    (sharded.repartition("shard", piece).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").option("maxRecordsPerFile", rows_per_file).parquet(path))


def record_digest(sharded: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per record: id, size, CRC-32 of the text, law, shard, slot."""
    return sharded.select(
        col(id_col), (F.octet_length(text_of(text_col)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text_of(text_col), "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
