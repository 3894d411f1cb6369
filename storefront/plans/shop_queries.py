"""Queries over customers, parts, orders and line items."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from storefront.functions.bands import price_tier
from storefront.functions.dates import between_days, in_year, on_day
from storefront.functions.money import mean, money
from storefront.operators import aggregate, clean, joins, profile
from storefront.plans.registry import query
from storefront.schemas import SHOP
from storefront.session import drop_at_end, scratch_path
from storefront.sources.csv import accepted, read_csv, rejected, typed_rows, write_csv
from storefront.sources.tables import literal_rows, load, run_sql

SHOP_TABLES = ("customer", "part", "orders", "lineitem")
# Orders from this day on count as recent.
RECENT = date(2001, 1, 1)


@query("csv_roundtrip", "SELECT * FROM part")
def csv_roundtrip(spark, folder):
    part = load(spark, folder, "part")
    path = scratch_path(spark, "part-csv")
    write_csv(part, path)
    drop_at_end(spark, path)
    return read_csv(spark, path, part.schema)


@query("csv_inferred", "SELECT * REPLACE (CAST(p_size AS BIGINT) AS p_size) FROM part")
def csv_inferred(spark, folder):
    """The same without a schema: the types are found in the texts."""
    path = scratch_path(spark, "part-csv")
    write_csv(load(spark, folder, "part"), path)
    drop_at_end(spark, path)
    return read_csv(spark, path)


def _raw_orders(spark, folder):
    """Orders as texts under the names of the shop table, with some that cannot be read."""
    status, price = F.col("o_orderstatus"), F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    return load(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(status == "P", F.concat(F.lit("C-"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        status.alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(price, F.lit(" USD"))).otherwise(price).alias("total_amount"),
    )


@query(
    "typed_orders",
    """SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_custkey AS INTEGER) AS customer_id,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, o_orderstatus AS status,
      CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS total_amount
    FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'""",
)
def typed_orders(spark, folder):
    read = accepted(typed_rows(_raw_orders(spark, folder), SHOP["orders"]))
    return read.withColumns({"order_date": F.col("order_date").cast("string"), "total_amount": F.col("total_amount").cast("double")})


@query(
    "typed_orders_rejected",
    """SELECT 'customer_id' AS column_name, 'not int' AS reason, count(*) AS n_rows, min('C-' || o_custkey) AS least
    FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'total_amount', 'not decimal(12,2)', count(*), min(CAST(o_totalprice AS DECIMAL(12,2)) || ' USD')
    FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def typed_orders_rejected(spark, folder):
    found = rejected(typed_rows(_raw_orders(spark, folder), SHOP["orders"]), "order_id")
    return found.groupBy("column_name", "reason").agg(F.count("*").alias("n_rows"), F.min("field").alias("least"))


@query(
    "values_rows",
    """SELECT status_name, count(*) AS n_orders
    FROM orders JOIN (VALUES ('F', 'Delivered'), ('O', 'Shipped'), ('P', 'Pending'))
      AS names(o_orderstatus, status_name) USING (o_orderstatus)
    GROUP BY status_name""",
)
def values_rows(spark, folder):
    names = literal_rows(
        spark,
        [("F", "Delivered"), ("O", "Shipped"), ("P", "Pending")],
        "o_orderstatus STRING, status_name STRING",
    )
    counted = load(spark, folder, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n_orders"))
    return counted.join(names, "o_orderstatus").select("status_name", "n_orders")


@query("scan_all", "SELECT * FROM customer")
def scan_all(spark, folder):
    return run_sql(spark, "SELECT * FROM {customer}", {"customer": load(spark, folder, "customer")})


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in SHOP_TABLES),
)
def table_counts(spark, folder):
    return profile.table_counts({t: load(spark, folder, t) for t in SHOP_TABLES})


@query("head_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def head_rows(spark, folder):
    return profile.head(load(spark, folder, "orders"), "o_orderkey")


@query("tail_rows", "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def tail_rows(spark, folder):
    return profile.tail(load(spark, folder, "orders"), "o_orderkey")


@query("distinct_values", "SELECT DISTINCT p_type FROM part")
def distinct_values(spark, folder):
    return load(spark, folder, "part").select("p_type").distinct()


@query(
    "missing_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing
        FROM documents LEFT JOIN labels USING (doc_id)"""
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
)
def missing_counts(spark, folder):
    covered = joins.outer_join(load(spark, folder, "documents"), load(spark, folder, "labels"), "doc_id", "left")
    return profile.missing_counts(covered)


@query(
    "duplicate_count",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates
    FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang) AS copies""",
)
def duplicate_count(spark, folder):
    return clean.duplicate_count(load(spark, folder, "documents"), ["text", "lang"])


@query("drop_duplicates", "SELECT DISTINCT text, lang FROM documents")
def drop_duplicates(spark, folder):
    return clean.drop_duplicates(load(spark, folder, "documents").select("text", "lang"))


@query("project_columns", "SELECT c_name, c_mktsegment, c_nationkey FROM customer")
def project_columns(spark, folder):
    return load(spark, folder, "customer").select("c_name", "c_mktsegment", "c_nationkey")


@query(
    "price_tier",
    """SELECT p_partkey, p_name, p_retailprice,
      CASE WHEN p_retailprice < 930 THEN 'Budget' WHEN p_retailprice BETWEEN 930 AND 970 THEN 'Mid-Range'
           ELSE 'Premium' END AS price_tier
    FROM part""",
)
def price_tiers(spark, folder):
    return load(spark, folder, "part").select(
        "p_partkey", "p_name", "p_retailprice", price_tier("p_retailprice", (930, 970)).alias("price_tier")
    )


@query("filter_eq", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(spark, folder):
    return load(spark, folder, "orders").where(F.col("o_orderstatus") == "F")


@query("filter_and", "SELECT * FROM part WHERE p_type = 'ECONOMY' AND p_retailprice > 950")
def filter_and(spark, folder):
    return load(spark, folder, "part").where((F.col("p_type") == "ECONOMY") & (F.col("p_retailprice") > 950))


@query(
    "filter_year_fn",
    "SELECT * FROM orders WHERE year(o_orderdate) = 1997 AND o_orderpriority = '1-URGENT'",
)
def filter_year_fn(spark, folder):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    # Same rows as year(o_orderdate) = 1997, in the form a scan can prune by.
    return load(spark, folder, "orders").where(in_year("o_orderdate", 1997) & urgent)


@query(
    "filter_date_between",
    """SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-08-10' AND DATE '1997-08-25'
    AND o_orderstatus != 'P'""",
)
def filter_date_between(spark, folder):
    days = between_days("o_orderdate", date(1997, 8, 10), date(1997, 8, 25))
    return load(spark, folder, "orders").where(days & (F.col("o_orderstatus") != "P"))


@query("filter_date_eq", "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-08-15'")
def filter_date_eq(spark, folder):
    return load(spark, folder, "orders").where(on_day("o_orderdate", date(1997, 8, 15)))


@query(
    "filter_year_range",
    "SELECT * FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'",
)
def filter_year_range(spark, folder):
    return load(spark, folder, "orders").where(in_year("o_orderdate", 1997))


@query("count_all", "SELECT count(*) AS n_orders FROM orders")
def count_all(spark, folder):
    return load(spark, folder, "orders").agg(F.count("*").alias("n_orders"))


@query(
    "sum_filtered",
    """SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_revenue
    FROM orders WHERE o_orderstatus = 'F'""",
)
def sum_filtered(spark, folder):
    delivered = load(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    return delivered.agg(F.sum(money("o_totalprice")).cast("double").alias("total_revenue"))


_AVG_PRICE = "CAST(sum(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) / count(p_retailprice)"


@query("avg_by_group", f"SELECT p_type, {_AVG_PRICE} AS avg_price FROM part GROUP BY p_type")
def avg_by_group(spark, folder):
    return load(spark, folder, "part").groupBy("p_type").agg(mean(money("p_retailprice")).alias("avg_price"))


@query(
    "status_revenue",
    """SELECT o_orderstatus, count(*) AS n_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_orderstatus ORDER BY total DESC, o_orderstatus""",
)
def status_revenue(spark, folder):
    totals = aggregate.totals_by(load(spark, folder, "orders"), "o_orderstatus", money("o_totalprice"))
    return totals.select("o_orderstatus", "n_rows", F.col("total").cast("double").alias("total"))


@query(
    "minmax_by_group",
    "SELECT p_type, max(p_retailprice) AS most_expensive, min(p_retailprice) AS cheapest FROM part GROUP BY p_type",
)
def minmax_by_group(spark, folder):
    return load(spark, folder, "part").groupBy("p_type").agg(
        F.max("p_retailprice").alias("most_expensive"), F.min("p_retailprice").alias("cheapest")
    )


@query(
    "having_avg",
    f"SELECT p_type, {_AVG_PRICE} AS avg_price FROM part GROUP BY p_type HAVING {_AVG_PRICE} > 950",
)
def having_avg(spark, folder):
    return avg_by_group(spark, folder).where(F.col("avg_price") > 950)


@query(
    "conditional_counts",
    """SELECT CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS delivered_count,
      CAST(sum(CASE WHEN o_orderstatus != 'F' THEN 1 ELSE 0 END) AS BIGINT) AS not_delivered_count
    FROM orders""",
)
def conditional_counts(spark, folder):
    orders = load(spark, folder, "orders")
    return aggregate.split_count(orders, "o_orderstatus", "F", "delivered_count", "not_delivered_count")


@query(
    "join_inner",
    """SELECT o_orderkey, o_orderdate, c_name, c_mktsegment, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_inner(spark, folder):
    customer = load(spark, folder, "customer")
    return (
        load(spark, folder, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderdate", "c_name", "c_mktsegment", "o_totalprice")
    )


@query(
    "join_three",
    """SELECT o_orderkey, p_name, l_quantity, l_extendedprice, l_discount
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey""",
)
def join_three(spark, folder):
    lines = load(spark, folder, "lineitem")
    return (
        load(spark, folder, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(load(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select("o_orderkey", "p_name", "l_quantity", "l_extendedprice", "l_discount")
    )


def _customers(spark, folder):
    return load(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")


def _orders(spark, folder):
    return load(spark, folder, "orders").withColumnRenamed("o_custkey", "custkey")


def _recent_orders(spark, folder):
    recent = _orders(spark, folder).where(F.col("o_orderdate") >= F.lit(RECENT))
    return recent.select("custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query(
    "join_left",
    """SELECT c_custkey AS custkey, c_name, o_orderkey, o_orderdate, o_totalprice FROM customer
    LEFT JOIN (SELECT * FROM orders WHERE o_orderdate >= DATE '2001-01-01') AS recent ON c_custkey = o_custkey""",
)
def join_left(spark, folder):
    customers = _customers(spark, folder).drop("c_mktsegment")
    return joins.outer_join(customers, _recent_orders(spark, folder), "custkey", "left")


@query(
    "inactive_customers",
    """SELECT c_custkey AS custkey, c_name FROM customer WHERE NOT EXISTS
    (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= DATE '2001-01-01')""",
)
def inactive_customers(spark, folder):
    customers = _customers(spark, folder).drop("c_mktsegment")
    return joins.without_match(customers, _recent_orders(spark, folder), "custkey")


@query(
    "join_right",
    """SELECT o_custkey AS custkey, c_name, o_orderkey, o_totalprice
    FROM (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') AS builders
    RIGHT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') AS delivered ON c_custkey = o_custkey""",
)
def join_right(spark, folder):
    builders = _customers(spark, folder).where("c_mktsegment = 'BUILDING'").drop("c_mktsegment")
    delivered = _orders(spark, folder).where("o_orderstatus = 'F'").select("custkey", "o_orderkey", "o_totalprice")
    # The kept side is the one with many rows per key, which Spark can split by itself.
    return builders.join(delivered, "custkey", "right")


@query(
    "join_full_audit",
    """SELECT coalesce(c_custkey, o_custkey) AS custkey, c_name, o_orderkey, o_orderdate, o_totalprice,
      CASE WHEN c_custkey IS NULL THEN 'right_only' WHEN o_custkey IS NULL THEN 'left_only' ELSE 'both' END AS side
    FROM (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') AS others
    FULL JOIN (SELECT * FROM orders WHERE o_orderdate >= DATE '2001-01-01') AS recent ON c_custkey = o_custkey""",
)
def join_full_audit(spark, folder):
    others = _customers(spark, folder).where("c_mktsegment <> 'BUILDING'").drop("c_mktsegment")
    return joins.outer_join(others, _recent_orders(spark, folder), "custkey", "full", side="side")


@query(
    "key_audit",
    """SELECT coalesce(c_custkey, o_custkey) AS custkey, coalesce(n_left, 0) AS n_left, coalesce(n_right, 0) AS n_right,
      CASE WHEN c_custkey IS NULL THEN 'right_only' WHEN o_custkey IS NULL THEN 'left_only' ELSE 'both' END AS side
    FROM (SELECT c_custkey, count(*) AS n_left FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY c_custkey) AS others
    FULL JOIN (SELECT o_custkey, count(*) AS n_right FROM orders WHERE o_orderdate >= DATE '2001-01-01' GROUP BY o_custkey) AS recent
      ON c_custkey = o_custkey""",
)
def key_audit(spark, folder):
    others = _customers(spark, folder).where("c_mktsegment <> 'BUILDING'")
    return joins.key_audit(others, _recent_orders(spark, folder), "custkey")
