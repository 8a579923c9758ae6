"""Changes that are committed after the window of their change time has been read.

A transaction may stamp its rows and commit later than the next extract. Such rows lie before the last window's end, where no
later window looks. With a lookback an extract reads its own window and that much time before it, and of the
earlier rows moves those that no export has moved yet.

What was moved is kept as receipts: per row its change times and a digest of all its columns, 32 bytes whatever the row's
width. Only receipts inside the lookback are read, by a filter that the Parquet scan takes. Equal rows are counted on both
sides, so a row that is there twice and was moved once is moved once more, and a row that a third of the table repeats is
added up before it is shuffled.

A receipt counts once the ledger says that its export succeeded: an export that died leaves rows that still have to move.
A row committed later than the lookback allows is not found; how long that is, is a setting of the job.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from tidemark import fs
from tidemark.functions.digests import row_digest
from tidemark.functions.predicates import time_window

_DIGEST, _SEEN, _ROW = "_digest", "_seen", "_row"


def digests(rows: DataFrame, times: list[str]) -> DataFrame:
    """(change times, digest, seen): how often each row occurs. This is what a receipt holds."""
    marked = rows.select(*times, row_digest(rows, rows.columns, null_safe=True).alias(_DIGEST))
    return marked.groupBy(_DIGEST).agg(*[F.first(t).alias(t) for t in times], F.count("*").alias(_SEEN))


def not_moved(rows: DataFrame, receipts: DataFrame) -> DataFrame:
    """The rows beyond those that the receipts hold, each as often as it is there more often than in the receipts."""
    whole = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in rows.columns])
    there = (rows.select(whole.alias(_ROW), row_digest(rows, rows.columns, null_safe=True).alias(_DIGEST))
             .groupBy(_DIGEST).agg(F.first(_ROW).alias(_ROW), F.count("*").alias("_n")))
    moved = receipts.groupBy(_DIGEST).agg(F.sum(_SEEN).alias(_SEEN))
    left = F.col("_n") - F.coalesce(F.col(_SEEN), F.lit(0))
    return (there.join(moved, _DIGEST, "left").withColumn("_left", left).filter("_left > 0")
            .select(_ROW, F.explode(F.sequence(F.lit(1), F.col("_left")))).select(f"{_ROW}.*"))


def with_late(source: DataFrame, times: list[str], last_end, run_start, since, receipts: DataFrame) -> DataFrame:
    """The rows of the window [last_end, run_start), and of the time from ``since`` on before it those that were not moved yet."""
    now, zone = time_window(times, last_end, run_start), time_window(times, since, last_end)
    late = source.where(F.coalesce(zone, F.lit(False)) & ~F.coalesce(now, F.lit(False)))
    return source.where(now).unionByName(not_moved(late, receipts.where(zone)))


class Receipts:
    """The receipts of one source table: a folder per batch."""

    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def add(self, rows: DataFrame, times: list[str], batch_id: int) -> None:
        digests(rows, times).write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def since(self, exported: dict[int, datetime], last_end: datetime, lookback: timedelta) -> datetime:
        """Where the lookback begins: not before the windows of exports (batch id, window end) that left no receipts, as nobody knows
        what those have moved."""
        there = set(fs.children(self.spark, self.folder))
        unknown = [end for b, end in exported.items() if f"batch={b}" not in there]
        return min(last_end, max([last_end - lookback, *unknown]))

    def read(self, exported: dict[int, datetime], since: datetime, source: DataFrame, times: list[str]) -> DataFrame:
        """The receipts of exports that can hold a row from ``since`` on. A row with one change time was moved by a window that
        ended later; one with several may have been moved by any."""
        there = set(fs.children(self.spark, self.folder))
        folders = [f"{self.folder}/batch={b}" for b, end in exported.items()
                   if f"batch={b}" in there and (len(times) > 1 or end > since)]
        kinds = ", ".join(f"`{t}` {source.schema[t].dataType.simpleString()}" for t in times)
        schema = f"{_DIGEST} binary, {kinds}, {_SEEN} long"
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)
