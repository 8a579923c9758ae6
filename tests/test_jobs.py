from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import fs
from tidemark.operators import ledger as runs
from tidemark.operators.ledger import Ledger
from tidemark.plans import job as jobs
from tidemark.session import workspace
from tidemark.sources import config, staged

SOURCE = {}


def _settings(name="t", **more):
    return {"source_db": "s", "source_schema": "dbo", "source_table": name, "target_db": "A", "target_schema": "P",
            "target_table": name.upper(), "load_type": "incremental", "scd_type": 1, "primary_key": "id",
            "cdc_columns": "changed", "cdc_type": "TIMESTAMP", "delimiter": "|", **more}


@pytest.fixture
def place(spark):
    root = workspace(spark, "job")
    return jobs.Place(spark, lambda job: SOURCE[job["source_table"]], f"{root}/stage", f"{root}/targets",
                      Ledger(spark, f"{root}/ledger"), archive=f"{root}/archive")


def _rows(spark, *rows):
    return spark.createDataFrame([(i, v, datetime.fromisoformat(at)) for i, v, at in rows],
                                 "id long, v string, changed timestamp_ntz")


def test_incremental_runs_move_only_changes(spark, place):
    SOURCE["t"] = _rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-01"))
    first = jobs.run_table(place, _settings(), "FULL", place.ledger.next_batch_id(), datetime(2024, 1, 10))
    assert (first["status"], first["rows_extracted"], first["rows_inserted"]) == ("SUCCESS", 2, 2)
    SOURCE["t"] = _rows(spark, (1, "a", "2024-01-01"), (2, "B", "2024-01-15"), (3, "c", "2024-01-16"),
                        (4, "late", "2024-02-01"))
    batch = place.ledger.next_batch_id()
    second = jobs.run_table(place, _settings(), "FULL", batch, datetime(2024, 1, 20))
    assert (second["rows_extracted"], second["rows_inserted"], second["rows_updated"]) == (2, 1, 1)
    assert (second["source_count"], second["target_count"]) == (4, 3)
    third = jobs.run_table(place, _settings(), "FULL", place.ledger.next_batch_id(), datetime(2024, 3, 1))
    assert (third["rows_extracted"], third["rows_inserted"]) == (1, 1)
    got = {r["id"]: r["v"] for r in place.target(_settings()).read().collect()}
    assert got == {1: "a", 2: "B", 3: "c", 4: "late"}
    assert staged.pending_batches(spark, place.stage, _settings()) == []
    state = place.ledger.state().where("batch_id = 10001").first()
    assert state["window_start"] == datetime(2024, 1, 10) and state["ingestion_completed"] == "YES"


def test_id_watermark_is_the_highest_exported_id(spark, place):
    job = _settings("ids", cdc_columns="id", cdc_type="ID", scd_type=0, primary_key=None)
    SOURCE["ids"] = spark.range(1, 6).withColumn("v", F.lit("x"))
    jobs.run_table(place, job, "FULL", 10000)
    SOURCE["ids"] = spark.range(1, 9).withColumn("v", F.lit("x"))
    again = jobs.run_table(place, job, "FULL", 10001)
    assert again["rows_extracted"] == 3 and place.target(job).count() == 8
    idle = jobs.run_table(place, job, "FULL", 10002)
    assert (idle["status"], idle["rows_extracted"]) == ("SUCCESS", 0)
    assert place.ledger.watermark(job)["max_id"] == 8


def test_exports_between_loads_are_not_lost(spark, place):
    """A load in between must not move the watermark past rows that were not extracted."""
    job = _settings("gap")
    SOURCE["gap"] = _rows(spark, (1, "a", "2024-01-01"))
    jobs.run_table(place, job, "EXPORT", 10000, datetime(2024, 1, 2))
    SOURCE["gap"] = _rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-03"))
    jobs.run_table(place, job, "INGEST", 10001, datetime(2024, 1, 4))
    jobs.run_table(place, job, "FULL", 10002, datetime(2024, 1, 5))
    assert place.target(job).count() == 2
    pending = runs.pending_exports(place.ledger.state())
    assert pending.count() == 0


def test_history_backlog_makes_a_version_per_batch(spark, place):
    job = _settings("hist", scd_type=2)
    for batch, (value, day) in enumerate((("a", 1), ("b", 2), ("c", 3)), 10000):
        SOURCE["hist"] = _rows(spark, (1, value, f"2024-01-0{day}"))
        jobs.run_table(place, job, "EXPORT", batch, datetime(2024, 1, day, 12))
    done = jobs.run_table(place, job, "LOAD", 10003, datetime(2024, 2, 1))
    assert (done["status"], done["rows_inserted"], done["rows_expired"]) == ("SUCCESS", 3, 2)
    rows = place.target(job).read().orderBy("eff_start_date").collect()
    assert [(r["v"], r["is_current"]) for r in rows] == [("a", False), ("b", False), ("c", True)]
    assert rows[0]["eff_end_date"] == rows[1]["eff_start_date"] > rows[0]["eff_start_date"]


def test_failed_load_can_be_run_again(spark, place, monkeypatch):
    job = _settings("again")
    SOURCE["again"] = _rows(spark, (1, "a", "2024-01-01"))
    with monkeypatch.context() as m:
        m.setattr(jobs.Target, "load", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("merge broke")))
        failed = jobs.run_table(place, job, "FULL", 10000, datetime(2024, 1, 2))
    assert failed["status"] == "FAILED" and "merge broke" in failed["log"]
    state = place.ledger.state().first()
    assert (state["merge_status"], state["audit_status"], state["ingestion_completed"]) == (
        "FAILED", "FAILED IN PREVIOUS STEP", "NO")
    done = jobs.run_table(place, job, "LOAD", 10001, datetime(2024, 1, 3))
    assert done["status"] == "SUCCESS" and place.target(job).count() == 1


def test_failed_append_is_not_loaded_twice(spark, place, monkeypatch):
    job = _settings("app", scd_type=0)
    SOURCE["app"] = _rows(spark, (1, "a", "2024-01-01"))
    with monkeypatch.context() as m:
        m.setattr(jobs.Target, "append", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("broke")))
        assert jobs.run_table(place, job, "FULL", 10000, datetime(2024, 1, 2))["status"] == "FAILED"
    SOURCE["app"] = _rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-03"))
    done = jobs.run_table(place, job, "FULL", 10001, datetime(2024, 1, 4))
    assert (done["status"], done["rows_inserted"], place.target(job).count()) == ("SUCCESS", 2, 2)
    assert [r["final_status"] for r in place.ledger.state().orderBy("batch_id").collect()] == ["SUCCESS"] * 2


def test_batch_of_a_dead_export_is_not_loaded(spark, place):
    from tidemark import fs
    job = _settings("dead")
    folder = staged.batch_folder(place.stage, job, 10000)
    staged.write_staged(_rows(spark, (1, "a", "2024-01-01")), folder)
    fs.remove(spark, f"{folder}/_SUCCESS")
    assert staged.pending_batches(spark, place.stage, job) == []


def test_settings_table_runs_enabled_jobs(spark, place):
    SOURCE["one"] = _rows(spark, (1, "a", "2024-01-01"))
    SOURCE["two"] = _rows(spark, (1, "a", "2024-01-01"))
    fields = config.CONFIG_SCHEMA
    rows = [tuple({**_settings(n), "active": on}.get(f) for f in fields.names) for n, on in (("one", True), ("two", False))]
    place.audit = f"{place.stage}/../audit"
    out = jobs.run_config(place, spark.createDataFrame(rows, fields), now=datetime(2024, 1, 2)).collect()
    assert [(r["table_name"], r["status"]) for r in out] == [("one", "SUCCESS")]
    audit = spark.read.option("recursiveFileLookup", "true").parquet(place.audit).first()
    assert audit["extract_end"] == datetime(2024, 1, 2) and audit["final_status"] == "SUCCESS"


def test_nothing_to_load_fails(spark, place):
    SOURCE["none"] = _rows(spark, (1, "a", "2024-01-01"))
    result = jobs.run_table(place, _settings("none"), "LOAD", 10000)
    assert result["status"] == "FAILED" and "nothing to load" in result["log"]


def test_rejects_are_kept(spark, place):
    job = _settings("odd", delimiter=",")
    SOURCE["odd"] = _rows(spark, (1, "a,b", "2024-01-01"), (2, "NULL", "2024-01-01"))
    done = jobs.run_table(place, job, "FULL", 10000, datetime(2024, 1, 2))
    assert (done["rows_inserted"], done["rows_rejected"]) == (2, 0)
    folder = staged.batch_folder(place.stage, job, 10001)
    spark.createDataFrame([("3,c,2024-01-03",), ("4,d",), ("x,e,2024-01-03",)], "l string").coalesce(1).write.option(
        "compression", "gzip").text(folder)
    done = jobs.run_table(place, job, "LOAD", 10001)
    assert (done["rows_inserted"], done["rows_rejected"]) == (1, 2)
    assert spark.read.parquet(f"{place.target(job).root}/_rejects").count() == 2


def test_batches_of_one_key_fold_to_the_last(spark, place):
    job = _settings("fold")
    for batch, (value, day) in enumerate((("new", 5), ("older change time", 4)), 10000):
        SOURCE["fold"] = _rows(spark, (1, value, f"2024-01-0{day}"))
        folder = staged.batch_folder(place.stage, job, batch)
        staged.write_staged(SOURCE["fold"], folder)
    jobs.run_table(place, job, "LOAD", 10005)
    assert place.target(job).read().first()["v"] == "older change time"


def test_custom_query_job(spark, place):
    SOURCE["t2"] = _rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-05"))
    place.custom_tables["t2"] = SOURCE["t2"]
    job = _settings("totals", scd_type=0, load_type="full", primary_key=None, cdc_columns=None,
                    custom_sql="SELECT v, count(*) AS n FROM {t2} WHERE changed < :extract_end_dttm GROUP BY v")
    done = jobs.run_table(place, job, "FULL", 10000, datetime(2024, 1, 3))
    assert done["status"] == "SUCCESS", done
    assert [tuple(r) for r in place.target(job).read().collect()] == [("a", 1)]
    again = jobs.run_table(place, job, "FULL", 10001, datetime(2024, 1, 9))  # its columns still fit the target
    assert again["status"] == "SUCCESS", again
    assert sorted(tuple(r) for r in place.target(job).read().collect()) == [("a", 1), ("b", 1)]


def test_empty_ledger(spark, place):
    assert place.ledger.next_batch_id() == 10000
    assert place.ledger.watermark(_settings()) is None
    place.ledger.event(10000, 1, 1, final_status="SUCCESS", merge_log="x" * 5000)
    place.ledger.event(10000, 1, 2, source_db="s")
    place.ledger.compact()
    state = place.ledger.state().first()
    assert state["source_db"] == "s" and len(state["merge_log"]) == 5000  # values are kept whole
    assert place.ledger.next_batch_id() == 10001


def test_json_settings(spark):
    import json
    folder = workspace(spark, "json")
    text = json.dumps({"export_dir": "x", "tables": [{"source_db": "S", "source_table": "T", "target_table": "T",
                                                      "active": True, "load_type": "incremental"}]}, indent=1)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)
    row = config.normalise(config.read_config(spark, folder)).first()
    assert (row["source_schema"], row["target_db"], row["load_type"], row["enabled"], row["scd_type"]) == (
        "dbo", "ANALYTICS", "INCREMENTAL", "Y", 0)


def test_stream_batch_runs_once(spark):
    from tidemark.functions.types import column_metadata, target_schema
    from tidemark.operators.target import Target
    from tidemark.streaming.staged_stream import apply_stream, read_stream
    rows = spark.range(4).withColumn("v", F.lit("x"))
    schema = target_schema(column_metadata(rows))
    stage = workspace(spark, "stage")
    staged.write_staged(rows, f"{stage}/batch_id=1")
    target = Target(spark, workspace(spark, "t")).create(schema)
    checkpoint = workspace(spark, "cp")

    def run(place):
        writer = apply_stream(read_stream(spark, stage, schema), target, [], "incremental", 0)
        writer.option("checkpointLocation", place).trigger(availableNow=True).start().awaitTermination()

    run(checkpoint)
    fs.remove(spark, f"{checkpoint}/commits")  # as if the driver had died between the load and Spark's commit
    run(checkpoint)
    assert target.count() == 4
    run(workspace(spark, "cp"))  # a stream of its own reads everything and applies it
    assert target.count() == 8


def test_stream_history_is_the_same_however_files_are_cut(spark):
    from tidemark.functions.types import column_metadata, target_schema
    from tidemark.operators.target import Target
    from tidemark.streaming.staged_stream import apply_stream, read_stream
    schema = target_schema(column_metadata(spark.range(1).withColumn("v", F.lit("x"))))
    history = target_schema(column_metadata(spark.range(1).withColumn("v", F.lit("x"))), history=True)
    stage = workspace(spark, "stage")
    for n in (1, 2, 10):
        staged.write_staged(spark.range(5).withColumn("v", F.concat(F.lit(n), F.when(F.col("id") > 2, 0).otherwise(n))),
                            f"{stage}/batch_id={n}", files=1)
    got = []
    for files in (1, 1000):
        target = Target(spark, workspace(spark, "t")).create(history, ["id"])
        apply_stream(read_stream(spark, stage, schema, files_per_trigger=files), target, ["id"], "incremental", 2,
                     run_at=lambda b: datetime(2024, 1, b)).option("checkpointLocation", workspace(spark, "cp")).trigger(
            availableNow=True).start().awaitTermination()
        got.append(sorted(map(tuple, target.read().collect()), key=str))
    assert got[0] == got[1] and len(got[0]) == 15 and sum(r[2] for r in got[0]) == 5


def test_records_of_one_streamed_file_meet_in_several_tasks(spark):
    from tidemark.functions.types import column_metadata, target_schema
    from tidemark.streaming.staged_stream import read_stream
    rows = spark.range(400).select("id", F.when(F.col("id") % 3 == 0, F.lit('a\n"b"|c')).when(F.col("id") % 3 == 1, F.lit("x")).alias("v"))
    stage, seen = workspace(spark, "stage"), []
    staged.write_staged(rows.unionByName(rows.limit(7)), f"{stage}/batch_id=4", files=1)
    assert staged.staged_files(spark, stage) == 1

    def look(part, number):
        seen.extend(part.select("id", "v", "_bad", "batch_id", "_file", F.spark_partition_id()).collect())

    text = read_stream(spark, stage, target_schema(column_metadata(rows)), files_per_trigger=1)
    text.writeStream.foreachBatch(look).option("checkpointLocation", workspace(spark, "cp")).trigger(
        availableNow=True).start().awaitTermination()
    text = {0: 'a\n"b"|c', 1: "x", 2: None}
    assert sorted((int(r[0]), r[1] or None) for r in seen) == sorted(
        ((i, text[i % 3]) for i in [*range(400), *(int(r[0]) for r in rows.limit(7).collect())]), key=lambda x: x[0])
    assert {r[2] for r in seen} == {None} and {r[3] for r in seen} == {4} and len({r[4] for r in seen}) == 1
    assert len({r[5] for r in seen}) > 1


def test_job_ids_follow_the_table(spark, place):
    SOURCE["a"] = SOURCE["b"] = _rows(spark, (1, "a", "2024-01-01"))
    jobs.run_many(place, [_settings("a"), _settings("b")], "EXPORT", 10000, now=datetime(2024, 1, 2))
    jobs.run_many(place, [_settings("b")], "LOAD", 10001, now=datetime(2024, 1, 3))
    state = {r["source_table"]: r for r in place.ledger.state().where("batch_id = 10000").collect()}
    assert (state["a"]["ingestion_completed"], state["b"]["ingestion_completed"]) == ("NO", "YES")
    assert len({r["job_id"] for r in place.ledger.state().where("source_table = 'b'").collect()}) == 1


def test_two_sources_of_one_target(spark, place):
    SOURCE["x"], SOURCE["y"] = _rows(spark, (1, "x", "2024-01-01")), _rows(spark, (2, "y", "2024-01-01"))
    both = [_settings("x", target_table="BOTH", scd_type=0), _settings("y", target_table="BOTH", scd_type=0)]
    for job in both:
        assert jobs.run_table(place, job, "FULL", 10000, datetime(2024, 1, 2))["status"] == "SUCCESS"
    assert sorted(r["v"] for r in place.target(both[0]).read().collect()) == ["x", "y"]


def test_archive_errors_are_only_noted(spark, place):
    SOURCE["arc"] = _rows(spark, (1, "a", "2024-01-01"))
    blocked = workspace(spark, "file")
    spark.range(1).coalesce(1).write.csv(blocked)
    place.archive = f"{blocked}/" + next(n for n in fs.children(spark, blocked) if n.startswith("part"))
    done = jobs.run_table(place, _settings("arc"), "FULL", 10000, datetime(2024, 1, 2))
    assert done["status"] == "SUCCESS" and place.target(_settings("arc")).count() == 1
    state = place.ledger.state().first()
    assert state["final_status"] == "SUCCESS" and "not archived" in state["copy_log"]


def test_full_backlog_is_marked_superseded(spark, place):
    job = _settings("whole", load_type="full")
    for batch in (10000, 10001):
        SOURCE["whole"] = _rows(spark, (batch, "v", "2024-01-01"))
        jobs.run_table(place, job, "EXPORT", batch, datetime(2024, 1, 2))
    jobs.run_table(place, job, "LOAD", 10002, datetime(2024, 1, 3))
    marks = {r["batch_id"]: r["ingestion_completed"] for r in place.ledger.state().collect()}
    assert marks == {10000: "SUPERSEDED", 10001: "YES", 10002: "YES"}
    assert [r["id"] for r in place.target(job).read().collect()] == [10001]
    assert runs.pending_exports(place.ledger.state()).count() == 0


def test_many_appends_keep_the_list_of_folders_short(spark, place):
    job = _settings("grow", scd_type=0, slices=2)
    for n in range(12):
        SOURCE["grow"] = _rows(spark, *[(n * 10 + i, "v", f"2024-01-{n + 1:02d}") for i in range(10)])
        jobs.run_table(place, job, "FULL", 10000 + n, datetime(2024, 1, n + 2))
    target = place.target(job)
    assert target.count() == 120 and len(target._load()["segments"]) <= 2 * 9
    assert target.applied(staged.source_name(job)) == [[10000, 10011]]


def test_encrypted_rows_stay_unchanged(spark, place):
    job = _settings("enc", scd_type=2, encryption_columns="v", load_type="incremental", cdc_columns=None)
    place.encryption_key = b"0123456789abcdef"
    SOURCE["enc"] = _rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-01"))
    counts = [jobs.run_table(place, job, "FULL", 10000 + n, datetime(2024, 1, 2 + n)) for n in range(2)]
    assert [c["rows_inserted"] for c in counts] == [2, 0] and counts[1]["rows_expired"] == 0
    from tidemark.functions.columns import decrypt, encrypt
    sealed = encrypt(SOURCE["enc"], ["v"], place.encryption_key)
    assert "0123456789" not in sealed._jdf.queryExecution().toString()
    assert [r["v"] for r in decrypt(sealed, ["v"], place.encryption_key).orderBy("id").collect()] == ["a", "b"]


def test_stream_archives_files_of_earlier_batches(spark):
    from tidemark.functions.types import column_metadata, target_schema
    from tidemark.operators.target import Target
    from tidemark.streaming.staged_stream import apply_stream, read_stream
    rows = spark.range(3).withColumn("v", F.lit("x"))
    schema = target_schema(column_metadata(rows))
    stage, done, checkpoint = workspace(spark, "stage"), workspace(spark, "done"), workspace(spark, "cp")
    target = Target(spark, workspace(spark, "t")).create(schema, ["id"])
    for n in range(3):
        staged.write_staged(rows.withColumn("v", F.lit(str(n))), f"{stage}/batch_id={n}")
        stream = read_stream(spark, stage, schema, archive=done)
        apply_stream(stream, target, ["id"], "incremental", 1).option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start().awaitTermination()
    assert [(r["id"], r["v"]) for r in target.read().orderBy("id").collect()] == [(0, "2"), (1, "2"), (2, "2")]


def test_files_of_a_cut_are_dealt_to_as_many_tasks(spark):
    import glob
    import gzip

    def lines(rows, **cut):
        folder = workspace(spark, "stage")
        n, top = staged.write_staged(rows, folder, files=1, highest="id", **cut)
        held = [gzip.open(f, "rt").read().split("\n")[:-1] for f in sorted(glob.glob(f"{folder}/*.csv.gz"))]
        # Spark names files by the task that wrote them
        tasks = {f.rsplit("/part-", 1)[1][:5] for f in glob.glob(f"{folder}/*.csv.gz")}
        assert len(tasks) == len(held) and n == sum(map(len, held)) == rows.count()
        assert sorted(int(x.split("|")[0].strip('"')) for h in held for x in h) == list(range(n)) and top == (n - 1 if n else None)
        return sorted(map(len, held))

    rows = spark.range(0, 1000, 1, 7).withColumn("v", F.lit("x" * 17)).withColumn("nothing", F.lit(None))
    assert lines(rows, rows_per_file=100) == [100] * 10
    assert lines(rows.where("id < 901"), rows_per_file=100) == [90] * 9 + [91]
    assert lines(rows, file_bytes=6000) == [200] * 5
    assert lines(rows) == [1000]
    assert lines(rows.limit(0), rows_per_file=10) == [0]


def test_work_table_is_cut_and_holds_good_and_bad_rows_apart(spark, monkeypatch):
    from tidemark import fs
    from tidemark.functions.types import ColumnMeta, target_schema
    monkeypatch.setattr(staged, "WORK_ROWS", 10)
    folder, work = workspace(spark, "stage"), workspace(spark, "work")
    staged.write_staged(spark.range(100).selectExpr("CASE WHEN id % 4 = 0 THEN 'x' ELSE string(id) END AS id"), folder, files=1)
    schema = target_schema([ColumnMeta("id", "int")])
    good, bad, counts = staged.materialise(staged.check_rows(staged.read_text(spark, folder, schema), schema), schema, work)
    assert counts == (100, 75, 25) and good.columns == ["id", "_file"]
    assert sorted(r["id"] for r in good.collect()) == [i for i in range(100) if i % 4]
    assert {r["_reason"] for r in bad.collect()} == {"bad value: id"} and bad.count() == 25
    assert len([n for n in fs.children(spark, work) if n.endswith(".parquet")]) == 10


def test_staged_files_are_dealt_out_to_tasks_in_small_parts(spark):
    """As many files as cores take at once are not the measure: a job of many files does not wait for a few tasks that hold most of them."""
    from tidemark import fs
    from tidemark.functions.types import ColumnMeta, target_schema
    name = "spark.sql.files.maxPartitionBytes"
    before, folder, work = spark.conf.get(name), workspace(spark, "stage"), workspace(spark, "work")
    staged.write_staged(spark.range(0, 480, 1, 48).selectExpr("string(id) AS id"), folder)
    schema = target_schema([ColumnMeta("id", "int")])
    good, _, counts = staged.materialise(staged.check_rows(staged.read_text(spark, folder, schema), schema), schema, work)
    assert counts == (480, 480, 0) and sorted(r["id"] for r in good.collect()) == list(range(480))
    assert len([n for n in fs.children(spark, work) if n.endswith(".parquet")]) >= 12
    assert spark.conf.get(name) == before


def test_a_setting_ends_with_the_last_thread_that_holds_it(spark):
    from tidemark.session import at_most, setting
    name = "spark.sql.files.maxPartitionBytes"
    before, one, two = spark.conf.get(name), setting(spark, "x.held", "1"), setting(spark, "x.held", "1")
    one.__enter__()
    two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get("x.held") == "1"
    two.__exit__(None, None, None)
    assert spark.conf.get("x.held", None) is None
    with pytest.raises(KeyError), at_most(spark, name, 1 << 20):
        assert spark.conf.get(name) == "1048576b"
        raise KeyError
    with setting(spark, name, "1k"), at_most(spark, name, 1 << 20):
        assert spark.conf.get(name) == "1024b"
    assert spark.conf.get(name) == before
