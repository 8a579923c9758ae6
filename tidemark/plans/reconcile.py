"""Reconciliation by content: which rows differ between two versions of a table.

Both sides are reduced to a table of checksums: a hash of the key gives the bucket, and each bucket keeps its row count and the
XOR and the sum of its row hashes. These are partial aggregates, so that at most one row per bucket and task is
shuffled. Only rows of buckets that differ are then compared one by one; rows of equal buckets never leave their
scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Buckets of the checksum table. With few differences nearly all buckets agree.
BUCKETS = 1 << 16


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _digest(columns: list[str]) -> list[Column]:
    """Two hashes of a row that tell NULL from empty."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def checksums(rows: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, x, s): the checksums of each bucket that has rows."""
    one, two = _digest([*keys, *columns])
    return rows.select(_bucket(keys, buckets).alias("bucket"), one.alias("a"), two.alias("b")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("x"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s"))


def differing_buckets(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    a, b = (checksums(side, keys, columns, buckets) for side in (left, right))
    same = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.x").eqNullSafe(F.col("b.x")) & F.col("a.s").eqNullSafe(F.col("b.s"))
    return a.alias("a").join(b.alias("b"), "bucket", "full").filter(~same).select("bucket")


def reconcile_rows(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str] | None = None,
                   buckets: int = BUCKETS) -> DataFrame:
    """The key and ``difference`` of each row that is ``changed``, ``lost`` (only in the source) or ``added`` (only in the target).

    Keys may repeat: a key's rows are compared as a whole, by their number and their contents in any order. NULL is a key like others.
    """
    columns = columns or [c for c in source.columns if c not in keys]
    differ = F.broadcast(differing_buckets(source, target, keys, columns, buckets))  # at most ``buckets`` numbers
    one, two = _digest(columns)
    sides = []
    for rows, side in ((source, "s"), (target, "t")):
        some = rows.withColumn("_bucket", _bucket(keys, buckets)).join(differ, F.col("_bucket") == F.col("bucket"), "left_semi")
        sides.append(some.select(*keys, F.lit(side).alias("_side"), one.alias("_a"), two.alias("_b")))

    def of(side: str, value: Column) -> Column:
        return F.when(F.col("_side") == side, value)

    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(*[
        f(of(side, v)).alias(f"{name}_{side}") for side in "st" for name, f, v in (
            ("n", F.count, F.lit(1)), ("x", F.bit_xor, F.col("_a")), ("s", F.sum, F.col("_b").cast("decimal(38,0)")))])
    same = (F.col("n_s") == F.col("n_t")) & F.col("x_s").eqNullSafe(F.col("x_t")) & F.col("s_s").eqNullSafe(F.col("s_t"))
    return both.filter(~same).select(*keys, F.when(F.col("n_t") == 0, "lost").when(F.col("n_s") == 0, "added")
                                     .otherwise("changed").alias("difference"))
