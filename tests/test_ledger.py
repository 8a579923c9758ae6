"""Checkpoints of the ledger: the same state from fewer files."""

from pyspark.sql import functions as F

from tidemark import fs
from tidemark.operators import ledger as runs
from tidemark.operators.ledger import Ledger
from tidemark.session import workspace

JOB = {"source_db": "s", "source_schema": "d", "source_table": "t1"}


def _old(spark, batches: int, jobs: int):
    """The events of many runs: one that says what runs, one that ends it."""
    grid = spark.range(batches * jobs).select(
        (10000 + F.floor(F.col("id") / jobs)).alias("batch_id"), (F.col("id") % jobs).alias("job_id"), "id")
    day = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id as int))")
    first = grid.select("batch_id", "job_id", (F.col("id") * 10).alias("seq"), F.lit("s").alias("source_db"), F.lit("d").alias("source_schema"),
                        F.concat(F.lit("t"), F.col("job_id")).alias("source_table"), F.lit("FULL").alias("execution_mode"))
    last = grid.select("batch_id", "job_id", (F.col("id") * 10 + 1).alias("seq"), F.lit("SUCCESS").alias("export_status"),
                       F.when(F.col("id") % 7 == 0, "FAILED").alias("merge_status"), day.alias("window_end"), F.lit("SUCCESS").alias("final_status"))
    return first, last


def _same(book: Ledger) -> None:
    whole, folded = runs.cascade(runs.fold(book.events())), book.state()
    assert whole.schema.names == folded.schema.names
    assert whole.exceptAll(folded).isEmpty() and folded.exceptAll(whole).isEmpty()


def test_checkpoint_and_tail_equal_the_whole_log(spark):
    book = Ledger(spark, workspace(spark, "ledger"))
    assert book.checkpoint() is None and book.next_batch_id() == 10000
    for rows in _old(spark, 1000, 5):  # 10,000 events
        book.append(rows)
    mark = book.watermark(JOB)
    assert book.checkpoint() == 1 and book.checkpoint() is None
    assert book.watermark(JOB) == mark and book.next_batch_id() == 11000
    # an event after the checkpoint ends a run that began before it; another begins
    book.event(10500, 2, 10**9, final_status="FAILED", merge_status="FAILED")
    book.event(11000, 1, 10**9, **JOB, execution_mode="EXPORT", export_status="SUCCESS")
    files = book._folded("execution_mode").inputFiles()
    assert not any(f"/{n}/" in f for f in files for n in book._parts()[1])  # old events are not read again
    assert sum("/state_" not in f for f in files) == 2
    assert book.next_batch_id() == 11001 and book.watermark(JOB)["batch_id"] == 11000
    _same(book)
    assert book.checkpoint() == 2 and len(fs.children(spark, f"{book.path}/_old")) == 2
    book.event(11001, 1, 10**9 + 1, **JOB, execution_mode="FULL")
    assert book.checkpoint(at_least=5) is None and book.checkpoint() == 3
    _same(book)
    assert book.events().count() == 10003 and book.exported(JOB)
    assert sorted(n for n, _ in book._manifests()) == [2, 3]


def test_a_checkpoint_that_died_changes_nothing(spark):
    book = Ledger(spark, workspace(spark, "ledger"))
    book.event(10000, 1, 1, **JOB, execution_mode="FULL", export_status="SUCCESS")
    book._fold_of((0, ""), book._folders()).write.parquet(f"{book.path}/_checkpoints/state_dead")
    fs.make(spark, f"{book.path}/unfinished")  # an event that is being written
    assert book._parts()[0] == (0, "") and book.watermark(JOB)["batch_id"] == 10000
    assert book.checkpoint() == 1 and "unfinished" not in book._parts()[1]
    book.compact()
    _same(book)


def test_two_checkpoints_at_once(spark):
    book, other = (Ledger(spark, workspace(spark, "ledger")) for _ in range(2))
    other = Ledger(spark, book.path)
    book.event(10000, 1, 1, **JOB, execution_mode="FULL", export_status="SUCCESS")
    seen = other._parts()
    assert book.checkpoint() == 1
    book.event(10001, 1, 2, **JOB, execution_mode="FULL", export_status="SUCCESS")
    other._parts = lambda: seen  # it listed the log before the other had ended
    assert other.checkpoint() == 1
    del other._parts
    _same(book)
    assert book.next_batch_id() == other.next_batch_id() == 10002
    assert book.checkpoint() == 2
    _same(book)
