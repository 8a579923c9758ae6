"""What the nearest-neighbour search moves: queries travel, and the traffic grows with the rows and not with their square."""

import json
import os
import subprocess
import sys

_SCRIPT = """
import sys
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tidemark.llm import ann
from tidemark.session import local_session
log = sys.argv[1]
spark = local_session(4, 4, "4g", **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + log,
                                     "spark.eventLog.compress": "false"})
for n in (10000, 20000, 40000):
    x = np.random.default_rng(n).normal(size=(n, 64))
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": list(x)}), f"{log}/{n}.parquet", row_group_size=n // 4)
    rows = spark.read.parquet(f"{log}/{n}.parquet")
    spark.sparkContext.setJobGroup(str(n), "")
    found = ann.search(rows, F.col("vec_id") % 20 == 0, block=2048).toPandas()
    hits = 0
    queries = range(0, n, max(20, n // 2000 * 20))
    for q in queries:
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(found.vec_id[found.query_id == q]) & set(np.argsort(-s)[:20].tolist()))
    print(n, len(found), hits / (20 * len(queries)), flush=True)
spark.stop()
"""


def test_shuffle_grows_with_the_rows(tmp_path):
    said = subprocess.run([sys.executable, "-c", _SCRIPT, str(tmp_path)], check=True, timeout=600, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": os.getcwd()}).stdout
    runs = [line.split() for line in said.splitlines()]
    assert [(int(n), int(rows)) for n, rows, _ in runs] == [(n, n) for n in (10000, 20000, 40000)]  # n / 20 queries, 20 each
    assert all(float(recall) >= 0.9 for *_, recall in runs)
    log = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path) for f in fs if f.startswith(("local-", "events_")) and not f.endswith(".crc")]
    events = [json.loads(line) for f in log for line in open(f)]
    group = {s: e["Properties"].get("spark.jobGroup.id") for e in events if e["Event"] == "SparkListenerJobStart" for s in e["Stage IDs"]}
    size = {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and group.get(e["Stage ID"]):
            g = int(group[e["Stage ID"]])
            size[g] = size.get(g, 0) + e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    print(said, size)
    assert size[20000] <= 2.2 * size[10000] and size[40000] <= 2.2 * size[20000]
