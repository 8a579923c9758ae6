"""Loads by digests and filters: same results as the plain loads, and less that is shuffled."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions.digests import row_digest
from tidemark.functions.types import with_history
from tidemark.operators import merge, narrow

COLUMNS = "a long, b string, name string, x double, raw binary"


def _rows(spark, rows, columns=COLUMNS):
    return spark.createDataFrame(rows, columns)


def _same(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_digests_tell_values_apart(spark):
    rows = _rows(spark, [(1, "1", "ab", 0.0, b"\xff"), (1, "1", "ab", -0.0, b"\xff"), (1, "1", "ab", 0.0, b"\xfe"),
                         (11, "", "ab", 0.0, b"\xff"), (1, "1a", "b", 0.0, b"\xff"), (None, None, "", None, None),
                         (None, "", None, None, None), (1, "1", "ab", float("nan"), b"\xff")])
    loose, strict = (rows.select(row_digest(rows, rows.columns, s)).distinct().count() for s in (False, True))
    assert (loose, strict) == (6, 7)


@pytest.mark.parametrize("null_safe", [False, True])
def test_history_by_digest_equals_the_plain_load(spark, null_safe):
    target = _rows(spark, [(1, "k", "same", 1.0, None), (2, "k", "old", 1.0, b"x"), (3, "k", None, 0.0, b""), (4, "k", "left", None, None),
                           (5, "k", "twice", 1.0, None), (5, "k", "twice too", 1.0, None), (None, "k", "no key", 1.0, None),
                           (6, "k", "both gone", 1.0, None), (6, "k", "gone too", 1.0, None), (7, None, "half a key", 2.0, None)])
    work = _rows(spark, [(1, "k", "same", 1.0, None), (2, "k", "new", 1.0, b"x"), (3, "k", "", -0.0, None), (5, "k", "twice", 1.0, None),
                         (6, "k", "third", 1.0, None), (None, "k", "no key", 1.0, None), (8, "k", "first", 1.0, None),
                         (7, None, "half a key", 2.0, None)])
    history = with_history(target, "2024-01-01 00:00:00").unionByName(with_history(work, "2023-01-01 00:00:00").withColumn("is_current", F.lit(None).cast("boolean")))
    run = "2024-02-01 00:00:00"
    want = merge.scd2(history, work, ["a", "b"], run, null_safe=null_safe)
    for bits in (1 << 15, 1 << 24):
        got = narrow.scd2_digest(narrow.with_digest(history, ["name", "x", "raw"], null_safe), work, ["A", "b"], run, null_safe=null_safe, bits=bits)
        _same(got.drop(narrow.DIGEST), want)
        assert got.where(F.col(narrow.DIGEST) != row_digest(got, ["name", "x", "raw"], null_safe)).isEmpty()
    none = narrow.scd2_digest(narrow.with_digest(history, ["name", "x", "raw"]), work.limit(0), ["a", "b"], run)
    _same(none.drop(narrow.DIGEST), history)
    _same(narrow.scd2_digest(narrow.with_digest(history.limit(0), ["name", "x", "raw"]), work, ["a", "b"], run).drop(narrow.DIGEST),
          merge.scd2(history.limit(0), work, ["a", "b"], run))


def test_upsert_with_a_filter_equals_the_plain_one(spark):
    target = _rows(spark, [(1, "k", "old", 1.0, None), (2, "k", "old", 1.0, None), (2, "k", "again", 1.0, None), (None, "k", "n", 1.0, None)])
    work = _rows(spark, [(2, "k", "new", 2.0, b"y"), (3, "k", "new", 2.0, None), (None, "k", "m", 3.0, None)])
    for t, w in ((target, work), (target.limit(0), work), (target, work.limit(0))):
        _same(narrow.upsert_filtered(t, w, ["a", "b"]), merge.scd1(t, w, ["a", "b"]))


_SCRIPT = """
import sys
from pyspark.sql import functions as F
from tidemark.functions.types import with_history
from tidemark.operators import narrow
from tidemark.session import local_session, workspace
log = sys.argv[1]
spark = local_session(4, 4, "2g", **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + log,
                                     "spark.eventLog.compress": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"})
wide = spark.range(200000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("v"))
wide.write.parquet(log + "/t")
target = spark.read.parquet(log + "/t")
work = target.where("id % 100 = 0").withColumn("v", F.lit("new"))
spark.sparkContext.setJobGroup("upsert", "")
narrow.upsert_filtered(target, work, ["id"]).write.format("noop").mode("overwrite").save()
narrow.with_digest(with_history(target, "2024-01-01 00:00:00"), ["v"]).write.parquet(log + "/h")
spark.sparkContext.setJobGroup("history", "")
narrow.scd2_digest(spark.read.parquet(log + "/h"), target.withColumn("v", F.when(F.col("id") % 100 == 0, "new").otherwise(F.col("v"))),
                   ["id"], "2024-02-01 00:00:00").write.format("noop").mode("overwrite").save()
spark.stop()
"""


def test_only_possible_matches_are_shuffled(tmp_path):
    subprocess.run([sys.executable, "-c", _SCRIPT, str(tmp_path)], check=True, timeout=280,
                   env={**os.environ, "PYTHONPATH": os.getcwd()})
    log = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path) for f in fs if f.startswith(("local-", "events_")) and not f.endswith(".crc")]
    events = [json.loads(line) for f in log for line in open(f)]
    group = {s: e["Properties"].get("spark.jobGroup.id") for e in events if e["Event"] == "SparkListenerJobStart" for s in e["Stage IDs"]}
    rows, size = {}, {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd":
            w = e["Task Metrics"]["Shuffle Write Metrics"]
            g = group.get(e["Stage ID"])
            rows[g] = rows.get(g, 0) + w["Shuffle Records Written"]
            size[g] = size.get(g, 0) + w["Shuffle Bytes Written"]
    # 2,000 work rows and their partners, and partial bitmaps of at most 512 buckets a task
    assert rows["upsert"] < 2 * 2000 + 2000 * 0.05 + 4 * 512 + 500
    # key and digest of 200,000 rows on either side (and of their aggregate), but the 128-character texts of few
    assert size["history"] < 40 * 600_000
