"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators rely on; everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.scheduler.mode": "FAIR",
    # Split writes keep a few files open per task and need no sort.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  **extra: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a session whose driver and executors are one process (``local[n]``) may leave it unset: it
    gets a folder of its own. On a cluster an unset folder is an error, because each
    executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh path for one run below the shared folder."""
    return f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


_held: dict[tuple[int, str], list] = {}
_holding = threading.Lock()


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the jobs that run inside. The session's own comes back when the last thread that holds it leaves."""
    key = id(spark._jsparkSession), name
    with _holding:
        held = _held.setdefault(key, [0, spark.conf.get(name, None)])
        held[0] += 1
        spark.conf.set(name, value)
    try:
        yield
    finally:
        with _holding:
            held[0] -= 1
            if not held[0]:
                del _held[key]
                if held[1] is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, held[1])


def at_most(spark: SparkSession, name: str, size: int):
    """The same for a number of bytes: a session that asks for fewer keeps its own."""
    now = spark.conf.get(name, None)
    asked = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) if now else 0
    return setting(spark, name, f"{min(size, asked) if asked > 0 else size}b")
