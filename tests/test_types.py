import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions import columns, predicates, types as ty
from tidemark.functions.types import ColumnMeta, target_schema
from tidemark.sources import staged
from tidemark.session import workspace


@pytest.mark.parametrize("meta, wanted", [
    (ColumnMeta("c", "INT"), T.IntegerType()), (ColumnMeta("c", "tinyint"), T.ShortType()),
    (ColumnMeta("c", "money"), T.DecimalType(19, 4)), (ColumnMeta("c", "smallmoney"), T.DecimalType(10, 4)),
    (ColumnMeta("c", "decimal", precision=12, scale=2), T.DecimalType(12, 2)),
    (ColumnMeta("c", "numeric"), T.DecimalType(38, 0)), (ColumnMeta("c", "datetime2"), T.TimestampNTZType()),
    (ColumnMeta("c", "datetimeoffset"), T.TimestampType()), (ColumnMeta("c", "varchar", -1), T.StringType()),
    (ColumnMeta("c", "varbinary", 8), T.BinaryType()), (ColumnMeta("c", "xml"), T.VariantType()),
    (ColumnMeta("c", "hierarchyid"), T.StringType()), (ColumnMeta("c", "bit"), T.BooleanType())])
def test_type_map(meta, wanted):
    assert ty.target_field(meta).dataType == wanted


def test_target_schema():
    schema = target_schema([ColumnMeta("id", "int", nullable=False), ColumnMeta("name", "varchar", 5)], history=True, upper=True)
    assert schema.names == ["ID", "NAME", "is_current", "eff_start_date", "eff_end_date"]
    assert not schema["ID"].nullable and schema["NAME"].metadata == {"max_length": 5}
    with pytest.raises(ValueError):
        target_schema([])


def _load(spark, lines, schema, **more):
    folder = workspace(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)
    return staged.check_rows(staged.read_text(spark, folder, schema, **more), schema)


def test_values_of_every_type(spark):
    kinds = [("i", "int"), ("t", "tinyint"), ("b", "bit"), ("f", "float"), ("m", "money"), ("d", "date"),
             ("ts", "datetime2"), ("tz", "datetimeoffset"), ("u", "uniqueidentifier"), ("x", "varbinary"), ("v", "xml")]
    schema = target_schema([ColumnMeta(*k) for k in kinds])
    line = "7|255|1|1.5|2.25|2024-01-02|2024-01-02 03:04:05.678901|2024-01-02 03:04:05+02:00|u|00FF|<r><a>1</a></r>"
    row = _load(spark, [line], schema).withColumn("v", F.col("v").cast("string")).first()
    assert row["_reason"] is None
    assert (row["i"], row["t"], row["b"], row["f"], str(row["m"])) == (7, 255, True, 1.5, "2.2500")
    assert row["ts"].microsecond == 678901 and bytes(row["x"]) == b"\x00\xff" and '"a":1' in row["v"]


def test_reject_reasons(spark):
    schema = target_schema([ColumnMeta("id", "int", nullable=False), ColumnMeta("name", "varchar", 3), ColumnMeta("n", "int")])
    lines = ["1|abc|5", "x|abc|5", "1|abcd|5", "NULL|abc|5", "1|abc", "1|abc|5|6", "1||NULL", '1|"a|b"|5', '1|"""q"|5', "1|abc|1.5"]
    checked = _load(spark, lines, schema)
    assert [r["_reason"] for r in checked.collect()] == [
        None, "bad value: id", "too long: name", "missing: id", "field count", "field count", None, None, None,
        "bad value: n"]
    assert [(r["name"], r["n"]) for r in staged.good_rows(checked, schema).collect()] == [
        ("abc", 5), (None, None), ("a|b", 5), ('"q', 5)]
    raw = [r["_raw"] for r in staged.rejects(checked).collect()]
    assert raw[3] == "1|abc" and '"id":"x"' in raw[0]


def test_field_count_is_checked_when_columns_are_pruned(spark):
    schema = target_schema([ColumnMeta("a", "int"), ColumnMeta("b", "int")])
    checked = _load(spark, ["1|2", "1", "1|2|3"], schema)
    assert staged.good_rows(checked, schema).select("a").count() == 1


def test_awkward_text_round_trip(spark):
    texts = ["a|b", 'say "x"', "two\nlines", "cr\r\nlf", " spaced ", "tab\t", "back\\slash", '"', "\\\"", "é ü 漢", "'"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    schema = target_schema(ty.column_metadata(df))
    folder = workspace(spark, "awkward")
    assert staged.write_staged(df, folder, highest="id") == (len(texts), len(texts) - 1)
    back = staged.good_rows(staged.check_rows(staged.read_text(spark, folder, schema), schema), schema)
    assert [r["text"] for r in back.orderBy("id").collect()] == texts


def test_empty_export(spark):
    df = spark.createDataFrame([], "id int, text string")
    folder = workspace(spark, "empty")
    assert staged.write_staged(df, folder) == (0, None)


def test_conditions():
    full = {"load_type": "full", "cdc_columns": "x"}
    assert predicates.extract_condition(full, None, "2024-01-01") is None
    assert predicates.extract_condition({"load_type": "filter"}, None, None) is None
    assert predicates.extract_condition({"load_type": "incremental", "cdc_columns": "x", "cdc_type": "ODD"}, None, None) is None
    assert predicates.name_list(" a , b,,") == ["a", "b"] and predicates.name_list(None) == []


def test_window_edges_and_nulls(spark):
    df = spark.sql("select * from values (timestamp_ntz'2024-01-01', 1), (timestamp_ntz'2024-01-02', 2), (null, 3) t(c, n)")
    found = df.where(predicates.time_window(["c"], "2024-01-01", "2024-01-02"))
    assert [r["n"] for r in found.collect()] == [1]
    assert df.where(predicates.time_window(["c"], "not a time", "2024-01-02")).count() == 0
    assert df.where(predicates.id_window("n", None)).count() == 3


def test_window_reaches_the_scan(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet").where(predicates.time_window(["ts"], "2024-01-05", "2024-01-06"))
    plan = df.select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan and "user_id" not in plan


def test_encryption_needs_a_key(spark):
    from tidemark.sources.tables import prepare
    with pytest.raises(ValueError):
        prepare(spark.range(1), {"encryption_columns": "id"})
    hidden = columns.encrypt(spark.range(3).withColumn("s", F.lit("x")), ["S"], b"0123456789abcdef")
    assert [r["s"] for r in columns.decrypt(hidden, ["s"], b"0123456789abcdef").collect()] == ["x"] * 3
