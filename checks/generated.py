"""Generated tables for the keys of the test tables, and the change set."""

from pyspark.sql import functions as F

from checks.common import check, table
from tidemark.plans import datagen as gen

NOW = "2024-06-01 12:00:00"
_P = gen._PRIME


def _noise(key: str, seed: int) -> str:
    x = f"(({key} + {seed * 7919 + 12345}) % {_P})"
    for step in (48271, 69621):
        x = f"((({x} * {step}) % {_P}) * (({x} + {seed}) % {_P}) + {step}) % {_P}"
        x = f"({x})"
    return x


def _below(key: str, seed: int, n: int) -> str:
    return f"({_noise(key, seed)} % {n})"


def _pick(key: str, seed: int, words: list[str]) -> str:
    return f"[{', '.join(repr(w) for w in words)}][CAST({_below(key, seed, len(words))} AS INTEGER) + 1]"


def _back(key: str, seed: int, n: int) -> str:
    return f"TIMESTAMP '{NOW}' - to_days(CAST({_below(key, seed, n)} AS INTEGER))"


def _customers(source: str, key: str) -> str:
    return f"""SELECT {key} AS customer_id, 'FName' || {key} AS first_name, 'LName' || {key} AS last_name,
      'customer' || {key} || '@company' || {_below(key, 1, 100)} || '.com' AS email,
      '+1-' || lpad(CAST({_below(key, 2, 999)} AS VARCHAR), 3, '0') || '-'
        || lpad(CAST({_below(key, 3, 9999)} AS VARCHAR), 4, '0') AS phone,
      {_pick(key, 4, gen.CITIES)} AS city, {_pick(key, 5, gen.STATES)} AS state, {_pick(key, 6, gen.COUNTRIES)} AS country,
      lpad(CAST({_below(key, 7, 99999)} AS VARCHAR), 5, '0') AS zip_code,
      {_pick(key, 8, gen.CUSTOMER_TYPES)} AS customer_type,
      CAST({_below(key, 9, 50000)} + 1000 AS DECIMAL(12,2)) AS credit_limit, {_below(key, 10, 100)} < 90 AS is_active,
      {_back(key, 11, 730)} AS created_at, {_back(key, 12, 30)} AS updated_at FROM {source}"""


_PRODUCTS = f"""SELECT p_partkey AS product_id,
  'Product-' || p_partkey || '-' || {_pick('p_partkey', 21, gen.PRODUCT_SUFFIXES)} AS product_name,
  {_pick('p_partkey', 22, gen.CATEGORIES)} AS category, {_pick('p_partkey', 23, gen.SUB_CATEGORIES)} AS sub_category,
  {_pick('p_partkey', 24, gen.BRANDS)} AS brand, 'SKU-' || right('00000' || p_partkey, 6) AS sku,
  CAST({_below('p_partkey', 25, 999)} + 1 + 0.99 AS DECIMAL(10,2)) AS unit_price,
  CAST({_below('p_partkey', 26, 500)} + 1 + 0.50 AS DECIMAL(10,2)) AS cost_price,
  CAST({_below('p_partkey', 27, 50)} + 0.1 AS DECIMAL(8,2)) AS weight, {_below('p_partkey', 28, 100)} < 85 AS is_active,
  {_back('p_partkey', 29, 365)} AS created_at, {_back('p_partkey', 30, 30)} AS updated_at FROM part"""


@check(_customers("customer", "c_custkey"))
def datagen_customers(spark, sf):
    return gen.customers(table(spark, sf, "customer"), NOW, "c_custkey")


@check(_PRODUCTS)
def datagen_products(spark, sf):
    return gen.products(table(spark, sf, "part"), NOW, "p_partkey")


_ORDERS = f"""SELECT o_orderkey AS order_id, {_below('o_orderkey', 41, 100000)} + 1 AS customer_id,
  {_below('o_orderkey', 42, 5000)} + 1 AS product_id,
  DATE '2024-06-01' - CAST({_below('o_orderkey', 43, 730)} AS INTEGER) AS order_date,
  DATE '2024-06-01' - CAST({_below('o_orderkey', 44, 720)} AS INTEGER) AS ship_date,
  CAST({_below('o_orderkey', 45, 20)} + 1 AS INTEGER) AS quantity,
  CAST({_below('o_orderkey', 46, 500)} + 10 AS DECIMAL(10,2)) AS unit_price,
  CAST({_below('o_orderkey', 47, 30)} AS DECIMAL(5,2)) AS discount,
  CAST(({_below('o_orderkey', 48, 20)} + 1) * ({_below('o_orderkey', 49, 500)} + 10) AS DECIMAL(12,2)) AS total_amount,
  {_pick('o_orderkey', 50, gen.ORDER_STATUSES)} AS order_status, {_pick('o_orderkey', 51, gen.PAYMENT_METHODS)} AS payment_method,
  {_pick('o_orderkey', 52, gen.SHIPPING_METHODS)} AS shipping_method, {_pick('o_orderkey', 53, gen.REGIONS)} AS region,
  {_back('o_orderkey', 54, 730)} AS created_at, {_back('o_orderkey', 55, 30)} AS updated_at FROM orders"""


@check(_ORDERS)
def datagen_orders(spark, sf):
    return gen.orders(table(spark, sf, "orders"), NOW, "o_orderkey")


_HIT = f"customer_id IN ({', '.join(map(str, gen.CHANGED_CUSTOMERS))})"


@check(f"""SELECT * REPLACE (
    CASE WHEN {_HIT} THEN 'updated_' || customer_id || '@newdomain.com' ELSE email END AS email,
    CASE WHEN {_HIT} THEN '999-' || right('000000' || customer_id, 7) ELSE phone END AS phone,
    CASE WHEN {_HIT} THEN 'UpdatedCity-' || customer_id ELSE city END AS city,
    CASE WHEN {_HIT} THEN TIMESTAMP '2024-07-01' ELSE updated_at END AS updated_at)
  FROM ({_customers('customer', 'c_custkey')})""")
def change_set_customers(spark, sf):
    made = gen.customers(table(spark, sf, "customer"), NOW, "c_custkey")
    return gen.change_customers(made, "2024-07-01 00:00:00")


@check(f"""SELECT * REPLACE (CASE WHEN product_id IN (1, 2, 3, 4, 5, 10, 20, 50, 100, 500)
      THEN CAST(unit_price * 1.10 AS DECIMAL(10,2)) ELSE unit_price END AS unit_price,
    CASE WHEN product_id IN (1, 2, 3, 4, 5, 10, 20, 50, 100, 500) THEN TIMESTAMP '2024-07-01' ELSE updated_at END
      AS updated_at) FROM ({_PRODUCTS})""")
def change_set_products(spark, sf):
    made = gen.products(table(spark, sf, "part"), NOW, "p_partkey")
    return gen.change_products(made, "2024-07-01 00:00:00")


@check(f"""SELECT * REPLACE (DATE '{NOW[:10]}' AS order_date, DATE '{NOW[:10]}' + CAST(order_id % 7 + 1 AS INTEGER) AS ship_date,
    quantity % 10 + 1 AS quantity, {_pick('order_id', 61, gen.NEW_ORDER_STATUSES)} AS order_status,
    TIMESTAMP '{NOW}' AS created_at, TIMESTAMP '{NOW}' AS updated_at) FROM ({_ORDERS})""")
def change_set_orders(spark, sf):
    """New orders, one per order key: placed today, shipped within a week."""
    return gen.new_orders(table(spark, sf, "orders"), NOW, "o_orderkey")
