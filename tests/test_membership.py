"""The membership filter never loses a key and drops most others."""

from pyspark.sql import functions as F

from tidemark.operators import membership


def test_every_member_is_kept_and_most_others_are_not(spark):
    keys = spark.range(0, 5000, 5).select((F.col("id") * 7919).alias("k"), F.col("id").cast("string").alias("s"))
    rows = spark.range(5000).select((F.col("id") * 7919).alias("k"), F.col("id").cast("string").alias("s"))
    members = membership.bitmaps(keys, F.col("k"), F.col("s"), bits=1 << 20)
    got = membership.may_match(rows, members, F.col("k"), F.col("s"), bits=1 << 20)
    assert got.columns == ["k", "s", "_may_match"]
    inside = got.join(keys, ["k", "s"], "left_semi")
    assert inside.count() == 1000 and inside.filter("_may_match").count() == 1000
    assert got.filter("_may_match").count() < 1050
    assert members.count() <= 32
    none = membership.may_match(rows, membership.bitmaps(keys.limit(0), F.col("k")), F.col("k"))
    assert none.filter("_may_match").count() == 0 and none.count() == 5000


def test_words_hold_the_same_members(spark):
    keys = spark.range(0, 50_000, 10).select((F.col("id") * 7919).alias("k"))
    rows = spark.range(50_000).select((F.col("id") * 7919).alias("k"))
    bits = membership.bits_for(5000)
    members = membership.bitmaps(keys, F.col("k"), bits=bits)
    flags = [membership.may_match(rows, m, F.col("k"), bits=bits) for m in (members, membership.in_words(members))]
    assert flags[0].exceptAll(flags[1]).isEmpty() and flags[1].filter("_may_match").count() < 5100
    assert flags[1].filter("_may_match").join(keys, "k", "left_semi").count() == 5000
    assert [membership.bits_for(n) for n in (0, 1 << 20, (1 << 20) + 1, 1 << 40)] == [1 << 23, 1 << 23, 1 << 24, 1 << 27]
