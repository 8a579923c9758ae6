"""Arrow batches in pieces of bounded text, for operators that work on whole texts in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import at_most

#: UTF-8 bytes of text that are worked on at once; a longer text is worked on alone.
PIECE_BYTES = 2 << 20


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers find this library also where only the driver's path names it."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = env.get("PYTHONPATH", "").split(":")
    if root not in known:
        env["PYTHONPATH"] = ":".join(filter(None, [*known, root]))


_kept: dict = {}


def kept(key, make: Callable):
    """What an operator keeps in its Python worker from task to task. A worker that turns to another operator forgets
    the last one's, so that a pipeline needs no more memory than its largest stage."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def mapped(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with workers that find this library."""
    reach_workers(df.sparkSession)
    return df.mapInArrow(run, schema)


def batches_of(spark: SparkSession, size: int):
    """Arrow batches of at most about ``size`` bytes for the jobs that run inside: whole texts come by megabytes and not by 10,000 rows, in the
    JVM's buffers as in the worker."""
    return at_most(spark, "spark.sql.execution.arrow.maxBytesPerBatch", size)


def pieces(batch: pa.RecordBatch, text_col: str, most: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """(slice of the batch, its texts with NULL as empty) of at most ``most`` bytes, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text_col))), 0).to_numpy()
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if i > start and size + n > most:
            yield _piece(batch, text_col, start, i)
            start, size = i, 0
        size += int(n)
    if len(lengths) > start:
        yield _piece(batch, text_col, start, len(lengths))


def _piece(batch, text_col, start, end):
    part = batch.slice(start, end - start)
    texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
    return part, [t or "" for t in texts]


def ints(lists: list[list[int]]) -> pa.Array:
    """A column of integer lists."""
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    flat = np.fromiter(chain.from_iterable(lists), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
