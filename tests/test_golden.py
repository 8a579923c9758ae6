"""The change scenarios with their known row counts."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.types import with_history
from tidemark.operators import merge
from tidemark.operators.target import Target
from tidemark.plans import datagen as gen, reports
from tidemark.session import workspace

NOW, LATER = "2024-06-01 12:00:00", "2024-07-01 00:00:00"


@pytest.fixture(scope="module")
def tables(spark):
    """The generated tables before and after the change set."""
    made = {"customers": gen.customers(gen.ids(spark, gen.CUSTOMERS), NOW),
            "products": gen.products(gen.ids(spark, gen.PRODUCTS), NOW),
            "orders": gen.orders(gen.ids(spark, gen.ORDERS), NOW)}
    changed = {"customers": gen.change_customers(made["customers"], LATER).unionByName(
                   gen.new_customers(spark, gen.CUSTOMERS + 1, LATER)),
               "products": gen.change_products(made["products"], LATER),
               "orders": made["orders"].unionByName(
                   gen.new_orders(gen.ids(spark, gen.NEW_ORDERS, gen.ORDERS + 1), LATER))}
    return made, changed


def _delta(changed):
    return changed.where(F.col("updated_at") >= F.lit(LATER).cast("timestamp_ntz"))


def test_seed_sizes(tables):
    made, _ = tables
    assert {n: t.count() for n, t in made.items()} == {"customers": 100_000, "products": 5_000, "orders": 1_000_000}


def test_change_set_sizes(tables):
    _, changed = tables
    assert {n: _delta(t).count() for n, t in changed.items()} == {"customers": 60, "products": 10, "orders": 100}


def test_customers_history(spark, tables):
    made, changed = tables
    target = merge.scd2(with_history(made["customers"], NOW), _delta(changed["customers"]), ["customer_id"], LATER)
    assert tuple(reports.history_summary(target).first()) == (100_060, 100_010, 50)


def test_products_history(spark, tables):
    made, changed = tables
    target = merge.scd2(with_history(made["products"], NOW), _delta(changed["products"]), ["product_id"], LATER)
    assert tuple(reports.history_summary(target).first()) == (5_010, 5_000, 10)
    prices = reports.price_history(target, "product_id", "unit_price").collect()
    assert len(prices) == 10 and all(p["new_price"] > p["old_price"] for p in prices)


def test_orders_upsert(tables):
    made, changed = tables
    keys = merge.scd1(made["orders"], _delta(changed["orders"]), ["order_id"]).select("order_id")
    assert keys.count() == 1_000_100


def test_generated_rows_do_not_depend_on_partitions(spark):
    one = gen.customers(gen.ids(spark, 500).repartition(1), NOW)
    many = gen.customers(gen.ids(spark, 500).repartition(7), NOW)
    assert one.exceptAll(many).isEmpty()


@pytest.fixture(scope="module")
def small(spark):
    """100 customers; five change, three are new; 500 orders, ten are new."""
    base = spark.range(1, 101).select(F.col("id").alias("customer_id"), F.concat(F.lit("c"), "id", F.lit("@x.com")).alias("email"),
                                      F.lit("555").alias("phone"), F.lit(NOW).cast("timestamp_ntz").alias("modified"))
    changed = base.where("customer_id <= 5").withColumns({
        "email": F.concat(F.lit("updated_"), "customer_id", F.lit("@newdomain.com")),
        "phone": F.concat(F.lit("999-000-"), F.lpad("customer_id", 4, "0")),
        "modified": F.lit(LATER).cast("timestamp_ntz")})
    new = spark.range(101, 104).select(F.col("id").alias("customer_id"), F.lit("demo@test.com").alias("email"),
                                       F.lit("555-0001").alias("phone"), F.lit(LATER).cast("timestamp_ntz").alias("modified"))
    return base, changed.unionByName(new)


def test_small_upsert(small):
    base, delta = small
    assert delta.count() == 8
    after = merge.scd1(base, delta, ["customer_id"])
    assert after.count() == 103
    assert after.where("email like 'updated_%' and phone like '999-000-%'").count() == 5
    assert merge.scd1_counts(base, delta, ["customer_id"]).first()["rows_inserted"] == 3


def test_small_history(spark, small):
    base, delta = small
    rows = with_history(base, NOW)
    target = Target(spark, workspace(spark, "small")).create(rows.schema, ["customer_id"], 3)
    target.seed(rows)
    folder = workspace(spark, "delta")
    delta.write.parquet(folder)
    counts = target.track(spark.read.parquet(folder), LATER)
    assert (counts.rows_inserted, counts.rows_expired) == (8, 5)
    assert target.read().count() == 108 and target.count() == 103
    versions = reports.key_history(target.read(), "customer_id = 1", ["email"], "customer_id").collect()
    assert [(v["is_current"], v["email"]) for v in versions] == [(True, "updated_1@newdomain.com"), (False, "c1@x.com")]
    # The same batch again changes nothing.
    counts = target.track(spark.read.parquet(folder), "2024-08-01 00:00:00")
    assert (counts.rows_inserted, counts.rows_expired) == (0, 0)
