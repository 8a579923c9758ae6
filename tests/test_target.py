import pytest
from pyspark.sql import functions as F

from tidemark import fs
from tidemark.operators.target import Target
from tidemark.session import workspace


def _target(spark, n=100, slices=4):
    rows = spark.range(n).withColumn("v", F.lit(0))
    target = Target(spark, workspace(spark, "t")).create(rows.schema, ["id"], slices)
    target.seed(rows)
    return target


def _folders(target, version=None):
    return {s.folder for s in target._load(version)["segments"]}


def test_upsert_rewrites_only_touched_slices(spark):
    target = _target(spark)
    before = _folders(target)
    counts = target.upsert(spark.createDataFrame([(7, 1)], "id long, v int"))
    assert (counts.rows_inserted, counts.rows_updated) == (0, 1)
    assert len(before) == 4 and len(before & _folders(target)) == 3
    assert target.read().count() == 100 and target.read().where("v = 1").count() == 1


def test_closed_history_is_not_rewritten(spark):
    from tidemark.functions.types import with_history
    rows = with_history(spark.range(50).withColumn("v", F.lit(0)), "2024-01-01")
    target = Target(spark, workspace(spark, "t")).create(rows.schema, ["id"], 2)
    target.seed(rows)
    for month in (2, 3):
        folder = workspace(spark, "w")
        spark.range(50).withColumn("v", F.lit(month)).write.parquet(folder)
        closed = {s.folder for s in target._load()["segments"] if s.kind == "closed"}
        target.track(spark.read.parquet(folder), f"2024-0{month}-01")
        assert closed <= {s.folder for s in target._load()["segments"] if s.kind == "closed"}
    assert target.read().count() == 150 and target.count() == 50


def test_append_lists_old_folders(spark):
    target = _target(spark, slices=1)
    before = _folders(target)
    target.append(spark.range(5).withColumn("v", F.lit(1)))
    assert before < _folders(target) and target.count() == 105


def test_failed_load_leaves_the_target(spark):
    target = _target(spark)
    bad = spark.range(3).select("id", F.raise_error(F.lit("boom")).cast("int").alias("v"))
    with pytest.raises(Exception):
        target.replace(bad)
    assert target.versions() == [1, 2] and target.count() == 100
    target.replace(spark.range(3).withColumn("v", F.lit(1)))
    assert target.count() == 3


def test_manifest_left_by_a_dead_writer_is_replaced(spark):
    target = _target(spark)
    spark.range(1).write.parquet(f"{target.root}/_manifest/v=3")
    fs.remove(spark, f"{target.root}/_manifest/v=3/_SUCCESS")
    assert target.versions() == [1, 2]
    target.truncate()
    assert target.versions() == [1, 2, 3] and target.count() == 0


def test_old_versions_stay_until_clean_up(spark):
    target = _target(spark, slices=1)
    for n in range(3):
        target.replace(spark.range(n + 1).withColumn("v", F.lit(n)))
    assert target.read(2).count() == 100
    assert target.clean_up(keep=1) == [1, 2, 3, 4]
    assert target.versions() == [5] and target.count() == 3


def test_view_follows_the_current_version(spark):
    target = _target(spark, slices=2)
    target.publish("t_view")
    assert spark.table("t_view").count() == 100
    target.replace(spark.range(2).withColumn("v", F.lit(1)))
    target.publish("t_view")
    assert spark.table("t_view").count() == 2


def test_update_delete_drop(spark):
    target = _target(spark)
    target.update("id < 10", {"v": F.col("v") + 5})
    target.delete("id >= 90 or id is null")
    assert target.count() == 90 and target.read().where("v = 5").count() == 10
    target.drop()
    assert not target.exists()


def test_slices_need_their_own_key(spark):
    target = _target(spark)
    with pytest.raises(ValueError):
        target.upsert(spark.range(1).withColumn("v", F.lit(1)), keys=["v"])


def test_compact_keeps_the_rows(spark):
    target = _target(spark, slices=1)
    for n in range(3):
        target.append(spark.range(n + 1).withColumn("v", F.lit(n)))
    before = target.read()
    target.compact(most=2)
    assert len(_folders(target)) == 1 and target.read().exceptAll(before).isEmpty() and target.count() == 106


def test_new_keys_rewrite_nothing(spark):
    target = _target(spark)
    before = _folders(target)
    counts = target.upsert(spark.range(1000, 1050).withColumn("v", F.lit(1)))
    assert (counts.rows_inserted, counts.rows_updated) == (50, 0)
    assert before < _folders(target) and target.count() == 150


def test_work_keys_of_another_type_find_their_slice(spark):
    target = _target(spark, slices=8)
    counts = target.upsert(spark.createDataFrame([(i, 1) for i in range(20)], "id int, v int"))
    assert (counts.rows_inserted, counts.rows_updated) == (0, 20) and target.count() == 100


@pytest.mark.parametrize("slices", [1, 3])
def test_few_work_rows_move_only_live_rows_they_may_match(spark, monkeypatch, slices):
    from tidemark.functions.types import with_history
    from tidemark.operators import merge
    monkeypatch.setattr(merge, "BROADCAST_BYTES", 0)
    joined, flag = [], merge.flag_changes

    def counted(current, *args, **kwargs):
        joined.append(current.count())
        return flag(current, *args, **kwargs)

    kinds = "a double, b string, v string"
    odd = [(0.0, "k", "same"), (float("nan"), "k", "old"), (None, "k", "no key"), (7.5, None, "half a key"), (7.5, "k", None),
           (8.5, "k", "twice"), (8.5, "k", "twice too"), (9.5, "k", "both gone"), (9.5, "k", "gone too"), (10.5, "k", "stays")]
    plain = spark.createDataFrame(odd, kinds).unionByName(spark.range(100, 1100).select(
        F.col("id").cast("double").alias("a"), F.lit("k").alias("b"), F.col("id").cast("string").alias("v")))
    work = spark.createDataFrame([(-0.0, "k", "same"), (float("nan"), "k", "new"), (None, "k", "no key"), (7.5, None, "half a key"),
                                  (7.5, "k", "new"), (8.5, "k", "twice"), (9.5, "k", "third"), (11.5, "k", "first"), (100.0, "k", "100"),
                                  (101.0, "k", "new")], kinds)
    history = with_history(plain, "2024-01-01 00:00:00").unionByName(
        with_history(work, "2023-01-01 00:00:00").withColumn("is_current", F.lit(False)))
    folder = workspace(spark, "w")
    work.write.parquet(folder)
    target = Target(spark, workspace(spark, "t")).create(history.schema, ["a", "b"], slices)
    target.seed(history)
    closed = {s.folder for s in target._load()["segments"] if s.kind == "closed"}
    want = merge.scd2(history, work, ["a", "b"], "2024-02-01 00:00:00")
    monkeypatch.setattr(merge, "flag_changes", counted)
    counts = target.track(spark.read.parquet(folder), "2024-02-01 00:00:00")
    assert max(joined) < 100  # the others, a thousand, are copied and not joined
    got = target.read()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert counts == (7, 0, 6) and target.count() == want.where("is_current").count()
    assert closed < {s.folder for s in target._load()["segments"] if s.kind == "closed"}
    # new keys alone rewrite nothing
    before, folder = _folders(target), workspace(spark, "w")
    spark.createDataFrame([(float(i), "new", "v") for i in range(20)], kinds).write.parquet(folder)
    assert target.track(spark.read.parquet(folder), "2024-03-01 00:00:00") == (20, 0, 0)
    assert before < _folders(target) and target.read().count() == want.count() + 20
