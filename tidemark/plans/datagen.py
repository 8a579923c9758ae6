"""Generated customers, products and orders, and the change set applied to them.

Rows are functions of their id and a seed, so a table is the same at every run, whatever its
partitioning, and any subset can be made again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Table sizes.
CUSTOMERS = 100_000
PRODUCTS = 5_000
ORDERS = 1_000_000
# Word lists.
CITIES = ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix", "Philadelphia", "San Antonio",
          "San Diego", "Dallas", "Austin"]
STATES = ["NY", "CA", "IL", "TX", "AZ", "PA", "TX", "CA", "TX", "TX"]
COUNTRIES = ["USA", "USA", "USA", "Canada", "UK"]
CUSTOMER_TYPES = ["Enterprise", "Business", "Individual", "Partner"]
PRODUCT_SUFFIXES = ["Pro", "Elite", "Basic", "Ultra", "Max"]
CATEGORIES = ["Electronics", "Clothing", "Home", "Sports", "Food", "Beauty", "Toys", "Office"]
SUB_CATEGORIES = ["Premium", "Standard", "Budget", "Luxury", "Eco", "Value"]
BRANDS = ["BrandA", "BrandB", "BrandC", "BrandD", "BrandE", "BrandF", "BrandG", "BrandH", "BrandI", "BrandJ"]
ORDER_STATUSES = ["Completed", "Shipped", "Processing", "Cancelled", "Returned"]
NEW_ORDER_STATUSES = ["Pending", "Confirmed", "Shipped", "Processing"]
PAYMENT_METHODS = ["CreditCard", "DebitCard", "PayPal", "BankTransfer"]
SHIPPING_METHODS = ["Standard", "Express", "Overnight"]
REGIONS = ["North", "South", "East", "West", "Central", "International"]
# Keys and rows of the change set.
CHANGED_CUSTOMERS = [
    1, 2, 3, 4, 5, 10, 15, 20, 25, 30, 50, 75, 100, 200, 300, 400, 500, 600, 700, 800, 1000, 1500, 2000, 2500,
    3000, 3500, 4000, 4500, 5000, 5500, 6000, 7000, 8000, 9000, 10000, 15000, 20000, 25000, 30000, 35000, 40000,
    50000, 60000, 70000, 80000, 85000, 90000, 92000, 95000, 99000]
CHANGED_PRODUCTS = [1, 2, 3, 4, 5, 10, 20, 50, 100, 500]
NEW_ORDERS = 100
NEW_CUSTOMERS = [
    ("Demo", "Alpha", "demo.alpha@test.com", "555-1001", "New York", "NY", "USA", "10001", "Premium", 15000),
    ("Demo", "Beta", "demo.beta@test.com", "555-1002", "London", None, "UK", "EC1A", "Standard", 5000),
    ("Demo", "Gamma", "demo.gamma@test.com", "555-1003", "Mumbai", "MH", "India", "400001", "Premium", 12000),
    ("Demo", "Delta", "demo.delta@test.com", "555-1004", "Sydney", "NSW", "Australia", "2000", "Standard", 8000),
    ("Demo", "Epsilon", "demo.epsilon@test.com", "555-1005", "Toronto", "ON", "Canada", "M5V", "Premium", 20000),
    ("Demo", "Zeta", "demo.zeta@test.com", "555-1006", "Berlin", None, "Germany", "10115", "Standard", 6000),
    ("Demo", "Eta", "demo.eta@test.com", "555-1007", "Tokyo", None, "Japan", "100", "Premium", 25000),
    ("Demo", "Theta", "demo.theta@test.com", "555-1008", "Paris", None, "France", "75001", "Standard", 7000),
    ("Demo", "Iota", "demo.iota@test.com", "555-1009", "Dubai", None, "UAE", "00000", "Premium", 30000),
    ("Demo", "Kappa", "demo.kappa@test.com", "555-1010", "Singapore", None, "Singapore", "048", "Standard", 9000)]

_PRIME = 2147483647


def noise(key: str, seed: int) -> Column:
    """A repeatable number in [0, 2^31-1) from an id; squaring twice breaks up runs of ids."""
    x = F.pmod(F.col(key).cast("long") + F.lit(seed * 7919 + 12345).cast("long"), F.lit(_PRIME))
    for step in (48271, 69621):
        x = F.pmod(F.pmod(x * F.lit(step), F.lit(_PRIME)) * F.pmod(x + F.lit(seed), F.lit(_PRIME)) + F.lit(step),
                   F.lit(_PRIME))
    return x


def below(key: str, seed: int, n: int) -> Column:
    return F.pmod(noise(key, seed), F.lit(n))


def pick(key: str, seed: int, words: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (below(key, seed, len(words)) + 1).cast("int"))


def digits(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _days_back(key: str, seed: int, n: int, now: str) -> Column:
    return F.timestamp_add("DAY", -below(key, seed, n), F.lit(now).cast("timestamp_ntz"))


def ids(spark: SparkSession, n: int, first: int = 1) -> DataFrame:
    return spark.range(first, first + n)


def customers(rows: DataFrame, now: str, key: str = "id") -> DataFrame:
    """Customer rows for the ids in ``key``."""
    number = F.col(key).cast("string")
    phone = F.concat(F.lit("+1-"), digits(below(key, 2, 999), 3), F.lit("-"), digits(below(key, 3, 9999), 4))
    return rows.select(
        F.col(key).cast("long").alias("customer_id"), F.concat(F.lit("FName"), number).alias("first_name"),
        F.concat(F.lit("LName"), number).alias("last_name"),
        F.concat(F.lit("customer"), number, F.lit("@company"), below(key, 1, 100).cast("string"), F.lit(".com"))
        .alias("email"),
        phone.alias("phone"), pick(key, 4, CITIES).alias("city"), pick(key, 5, STATES).alias("state"),
        pick(key, 6, COUNTRIES).alias("country"), digits(below(key, 7, 99999), 5).alias("zip_code"),
        pick(key, 8, CUSTOMER_TYPES).alias("customer_type"),
        (below(key, 9, 50000) + 1000).cast("decimal(12,2)").alias("credit_limit"),
        (below(key, 10, 100) < 90).alias("is_active"),
        _days_back(key, 11, 730, now).alias("created_at"), _days_back(key, 12, 30, now).alias("updated_at"))


def products(rows: DataFrame, now: str, key: str = "id") -> DataFrame:
    number = F.col(key).cast("string")
    return rows.select(
        F.col(key).cast("long").alias("product_id"),
        F.concat(F.lit("Product-"), number, F.lit("-"), pick(key, 21, PRODUCT_SUFFIXES)).alias("product_name"),
        pick(key, 22, CATEGORIES).alias("category"), pick(key, 23, SUB_CATEGORIES).alias("sub_category"),
        pick(key, 24, BRANDS).alias("brand"),
        F.concat(F.lit("SKU-"), F.right(F.concat(F.lit("00000"), number), F.lit(6))).alias("sku"),
        (below(key, 25, 999) + F.lit(1) + F.expr("0.99BD")).cast("decimal(10,2)").alias("unit_price"),
        (below(key, 26, 500) + F.lit(1) + F.expr("0.50BD")).cast("decimal(10,2)").alias("cost_price"),
        (below(key, 27, 50) + F.expr("0.1BD")).cast("decimal(8,2)").alias("weight"),
        (below(key, 28, 100) < 85).alias("is_active"),
        _days_back(key, 29, 365, now).alias("created_at"), _days_back(key, 30, 30, now).alias("updated_at"))


def orders(rows: DataFrame, now: str, key: str = "id", n_customers: int = CUSTOMERS,
           n_products: int = PRODUCTS) -> DataFrame:
    today = F.to_date(F.lit(now).cast("timestamp_ntz"))
    return rows.select(
        F.col(key).cast("long").alias("order_id"), (below(key, 41, n_customers) + 1).alias("customer_id"),
        (below(key, 42, n_products) + 1).alias("product_id"),
        F.date_sub(today, below(key, 43, 730).cast("int")).alias("order_date"),
        F.date_sub(today, below(key, 44, 720).cast("int")).alias("ship_date"),
        (below(key, 45, 20) + 1).cast("int").alias("quantity"),
        (below(key, 46, 500) + 10).cast("decimal(10,2)").alias("unit_price"),
        below(key, 47, 30).cast("decimal(5,2)").alias("discount"),
        ((below(key, 48, 20) + 1) * (below(key, 49, 500) + 10)).cast("decimal(12,2)").alias("total_amount"),
        pick(key, 50, ORDER_STATUSES).alias("order_status"), pick(key, 51, PAYMENT_METHODS).alias("payment_method"),
        pick(key, 52, SHIPPING_METHODS).alias("shipping_method"), pick(key, 53, REGIONS).alias("region"),
        _days_back(key, 54, 730, now).alias("created_at"), _days_back(key, 55, 30, now).alias("updated_at"))


def change_customers(table: DataFrame, now: str) -> DataFrame:
    """The customers table after the change set's updates."""
    hit = F.col("customer_id").isin(CHANGED_CUSTOMERS)
    number = F.col("customer_id").cast("string")
    new = {"email": F.concat(F.lit("updated_"), number, F.lit("@newdomain.com")),
           "phone": F.concat(F.lit("999-"), F.right(F.concat(F.lit("000000"), number), F.lit(7))),
           "city": F.concat(F.lit("UpdatedCity-"), number), "updated_at": F.lit(now).cast("timestamp_ntz")}
    return table.withColumns({n: F.when(hit, v).otherwise(F.col(n)) for n, v in new.items()})


def new_customers(spark: SparkSession, first_id: int, now: str) -> DataFrame:
    names = ["first_name", "last_name", "email", "phone", "city", "state", "country", "zip_code", "customer_type"]
    schema = "customer_id long, " + ", ".join(f"{n} string" for n in names) + ", credit_limit int"
    rows = spark.createDataFrame([(first_id + i, *r) for i, r in enumerate(NEW_CUSTOMERS)], schema)
    at = F.lit(now).cast("timestamp_ntz")
    return rows.select("customer_id", *names, F.col("credit_limit").cast("decimal(12,2)"),
                       F.lit(True).alias("is_active"), at.alias("created_at"), at.alias("updated_at"))


def change_products(table: DataFrame, now: str) -> DataFrame:
    """Ten per cent on some prices."""
    hit = F.col("product_id").isin(CHANGED_PRODUCTS)
    return table.withColumns({
        "unit_price": F.when(hit, (F.col("unit_price") * F.expr("1.10BD")).cast("decimal(10,2)"))
        .otherwise(F.col("unit_price")),
        "updated_at": F.when(hit, F.lit(now).cast("timestamp_ntz")).otherwise(F.col("updated_at"))})


def new_orders(rows: DataFrame, now: str, key: str = "id") -> DataFrame:
    """Orders placed today."""
    today = F.to_date(F.lit(now).cast("timestamp_ntz"))
    at = F.lit(now).cast("timestamp_ntz")
    return orders(rows, now, key).withColumns({
        "order_date": today, "ship_date": F.date_add(today, (F.pmod("order_id", F.lit(7)) + 1).cast("int")),
        "quantity": F.pmod(F.col("quantity"), F.lit(10)) + 1,
        "order_status": pick("order_id", 61, NEW_ORDER_STATUSES), "created_at": at, "updated_at": at})
