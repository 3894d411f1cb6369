"""Constraint checks and change batches over the shop tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.operators import changes, joins, quality
from storefront.plans.registry import query
from storefront.plans.shop_queries import RECENT
from storefront.schemas import ForeignKey, TableRules
from storefront.session import land, spread
from storefront.sources.tables import load

CUSTOMER = TableRules(
    name="customer",
    primary_key=("c_custkey",),
    not_null=("c_name", "c_mktsegment"),
    checks={"balance_not_negative": "c_acctbal >= 0"},
)
PART = TableRules(
    name="part",
    primary_key=("p_partkey",),
    unique=(("p_name",),),
    not_null=("p_name", "p_type"),
    checks={"price_positive": "p_retailprice > 0"},
)
ORDERS = TableRules(
    name="orders",
    primary_key=("o_orderkey",),
    not_null=("o_custkey", "o_orderdate", "o_orderstatus"),
    checks={"status_known": "o_orderstatus IN ('F', 'O')"},
    foreign_keys=(
        ForeignKey(
            ("o_custkey",), "customer", ("c_custkey",), where="c_mktsegment = 'BUILDING'", named="o_custkey_to_building_customer"
        ),
    ),
)
LINEITEM = TableRules(
    name="lineitem",
    primary_key=("l_orderkey", "l_linenumber"),
    not_null=("l_partkey", "l_quantity"),
    checks={"quantity_positive": "l_quantity > 0", "discount_is_share": "l_discount BETWEEN 0 AND 1"},
    foreign_keys=(
        ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
        ForeignKey(("l_partkey",), "part", ("p_partkey",)),
    ),
)
REPORTED = {r.name: r for r in (CUSTOMER, PART, ORDERS, LINEITEM)}

# The rules a batch of new orders has to keep.
STOCKED = {
    "part": TableRules(
        name="part",
        primary_key=("p_partkey",),
        checks={"stock_not_negative": "stock >= 0"},
    ),
    "orders": TableRules(
        name="orders",
        primary_key=("o_orderkey",),
        not_null=("o_custkey", "o_orderdate"),
        checks={"status_known": "o_orderstatus IN ('F', 'O', 'P')", "total_not_negative": "o_totalprice >= 0"},
        foreign_keys=(ForeignKey(("o_custkey",), "customer", ("c_custkey",)),),
    ),
    "lineitem": LINEITEM,
}


@query(
    "pk_violations",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
)
def pk_violations(spark, folder):
    return quality.primary_key_violations(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "unique_violations",
    "SELECT p_name, count(*) AS n_rows FROM part WHERE p_name IS NOT NULL GROUP BY p_name HAVING count(*) > 1",
)
def unique_violations(spark, folder):
    return quality.unique_violations(load(spark, folder, "part"), ["p_name"])


@query(
    "notnull_violations",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS column_name, count(*) - count({c}) AS n_rows
        FROM documents LEFT JOIN labels USING (doc_id)) AS c_{c} WHERE n_rows > 0"""
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
)
def notnull_violations(spark, folder):
    covered = joins.outer_join(load(spark, folder, "documents"), load(spark, folder, "labels"), "doc_id", "left")
    return quality.not_null_violations(covered, covered.columns)


@query("check_violations", "SELECT * FROM customer WHERE NOT coalesce(c_acctbal >= 0, TRUE)")
def check_violations(spark, folder):
    return quality.check_violations(load(spark, folder, "customer"), "c_acctbal >= 0")


@query("enum_violations", "SELECT * FROM orders WHERE NOT coalesce(o_orderstatus IN ('F', 'O'), TRUE)")
def enum_violations(spark, folder):
    return quality.check_violations(load(spark, folder, "orders"), F.col("o_orderstatus").isin("F", "O"))


_ORPHANS_SQL = """SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey IS NOT NULL
    AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY o_custkey"""


@query("fk_violations", _ORPHANS_SQL)
def fk_violations(spark, folder):
    return quality.orphans(load(spark, folder, "orders"), ORDERS.foreign_keys[0], load(spark, folder, "customer"))


def _part_sql(table: str, name: str, kind: str, key: str, body: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS constraint_name, '{kind}' AS kind, "
        f"CAST({key} AS VARCHAR) AS \"key\", count(*) AS n_rows FROM {body}"
    )


_REPORT_SQL = " UNION ALL ".join(
    [
        _part_sql("customer", "balance_not_negative", "check", "c_custkey",
                  "customer WHERE c_acctbal < 0 GROUP BY c_custkey"),
        _part_sql("orders", "status_known", "check", "o_orderkey",
                  "orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderkey"),
        _part_sql("part", "p_name_unique", "unique", "p_name",
                  "part WHERE p_name IS NOT NULL GROUP BY p_name HAVING count(*) > 1"),
        _part_sql("lineitem", "primary_key", "primary_key", "l_orderkey || '|' || l_linenumber",
                  "lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
        _part_sql("orders", "o_custkey_to_building_customer", "foreign_key", "o_custkey",
                  "orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') "
                  "GROUP BY o_custkey"),
    ]
)


@query("violation_report", _REPORT_SQL)
def violation_report(spark, folder):
    return quality.violation_report({name: load(spark, folder, name) for name in REPORTED}, REPORTED)


def _by_age(spark, folder):
    """Orders before the recent ones, and the recent ones."""
    orders = load(spark, folder, "orders")
    recent = F.col("o_orderdate") >= F.lit(RECENT)
    return orders.where(~recent), orders.where(recent)


@query(
    "insert_defaults",
    """SELECT o_orderkey, o_custkey, 'P' AS o_orderstatus, o_totalprice, o_orderdate,
      CAST(NULL AS VARCHAR) AS o_orderpriority
    FROM orders WHERE o_orderdate >= DATE '2001-01-01'""",
)
def insert_defaults(spark, folder):
    old, new = _by_age(spark, folder)
    return changes.with_defaults(new.drop("o_orderstatus", "o_orderpriority"), old, {"o_orderstatus": "'P'"})


# The day on which the batch of ``insert_on_day`` comes in; without one it is the current date.
ENTRY_DAY = date(2002, 1, 31)


@query(
    "insert_on_day",
    """SELECT * REPLACE (CASE WHEN o_orderdate >= DATE '2001-01-01' THEN TIMESTAMP '2002-01-31 00:00:00' ELSE o_orderdate END
      AS o_orderdate) FROM orders""",
)
def insert_on_day(spark, folder):
    """Recent orders come in anew, dated by a bound parameter."""
    old, new = _by_age(spark, folder)
    return changes.append_rows(old, changes.dated(new, "o_orderdate", ENTRY_DAY))


@query(
    "append_rows",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= DATE '2001-01-01' THEN 'P' ELSE o_orderstatus END
      AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
)
def append_rows(spark, folder):
    old, new = _by_age(spark, folder)
    return changes.append_rows(old, new.drop("o_orderstatus"), {"o_orderstatus": "'P'"})


def _stocked_parts(spark, folder) -> DataFrame:
    stock = (F.col("p_size") * 1000).cast("bigint")
    return load(spark, folder, "part").select("p_partkey", "p_name", stock.alias("stock"))


@query(
    "stock_update",
    """SELECT p_partkey, p_name, CAST(p_size * 1000 - coalesce(taken, 0) AS BIGINT) AS stock FROM part
    LEFT JOIN (SELECT l_partkey, sum(CAST(l_quantity AS BIGINT)) AS taken FROM lineitem GROUP BY l_partkey) AS t
      ON p_partkey = l_partkey""",
)
def stock_update(spark, folder):
    sold = load(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    return changes.subtract_stock(_stocked_parts(spark, folder), sold, "p_partkey", "stock")


def _stock_taken(lines: DataFrame) -> DataFrame:
    return lines.select(F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").alias("quantity"))


def _recent_batch(spark, folder, merge_lines: bool):
    """Recent orders with their lines and stock changes, on top of the older ones.

    Lines go with their order, so the older ones are the table as it is. Merged, each line key
    of the batch occurs once and the batch keeps all rules; as is, line keys repeat.
    """
    old_orders, new_orders = _by_age(spark, folder)
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint").alias("l_quantity"),
        "l_discount", "l_shipdate",
    )
    new = spread(new_orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    new_lines = lines.join(new, "l_orderkey", "left_semi")
    if merge_lines:
        new_lines = new_lines.groupBy("l_orderkey", "l_linenumber").agg(
            F.sum("l_quantity").alias("l_quantity"),
            *[F.min(c).alias(c) for c in ("l_partkey", "l_discount", "l_shipdate")],
        )
    existing = {
        "customer": load(spark, folder, "customer"),
        "part": _stocked_parts(spark, folder),
        "orders": old_orders,
        "lineitem": lines.join(new, "l_orderkey", "left_anti"),
    }
    batch = {"orders": new_orders, "lineitem": new_lines}
    update = changes.StockUpdate("part", _stock_taken(new_lines), "p_partkey", "stock", "quantity")
    return existing, batch, STOCKED, update


def _applied(spark, folder, merge_lines: bool) -> changes.BatchResult:
    return changes.apply_batch(*_recent_batch(spark, folder, merge_lines))


def _state_summary(result: changes.BatchResult) -> DataFrame:
    """Rows and total of each table after the batch, with the verdict."""
    totals = {"part": "stock", "orders": "o_orderkey", "lineitem": "l_quantity"}
    rows = [
        result.tables[name]
        .agg(F.count("*").alias("n_rows"), F.sum(amount).cast("bigint").alias("total"))
        .select(F.lit(name).alias("table_name"), "n_rows", "total")
        for name, amount in totals.items()
    ]
    accepted = result.verdict.select("accepted").scalar()
    return reduce(DataFrame.unionByName, rows).withColumn("accepted", accepted)


# Of the rules, only the stock can fail once repeated line keys are merged.
_LINES_SQL = """WITH lines AS (
  SELECT lineitem.*, CAST(l_quantity AS BIGINT) AS quantity, o_orderkey IS NOT NULL AS is_new
  FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '2001-01-01') AS o ON l_orderkey = o_orderkey),
new_lines AS (
  SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, sum(quantity) AS quantity
  FROM lines WHERE is_new GROUP BY l_orderkey, l_linenumber),
taken AS (
  SELECT l_partkey, sum(quantity) AS taken FROM new_lines GROUP BY l_partkey),
verdict AS (
  SELECT count(*) = 0 AS accepted FROM part JOIN taken ON p_partkey = l_partkey WHERE p_size * 1000 - taken < 0),
stocked AS (
  SELECT p_partkey, p_name,
    CAST(p_size * 1000 - CASE WHEN accepted THEN coalesce(taken, 0) ELSE 0 END AS BIGINT) AS stock
  FROM part LEFT JOIN taken ON p_partkey = l_partkey CROSS JOIN verdict)
"""


@query(
    "batch_accepted",
    _LINES_SQL
    + """SELECT t.*, accepted FROM (
      SELECT 'part' AS table_name, count(*) AS n_rows, CAST(sum(stock) AS BIGINT) AS total FROM stocked
      UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT)
        FROM orders CROSS JOIN verdict WHERE accepted OR o_orderdate < DATE '2001-01-01'
      UNION ALL SELECT 'lineitem', count(*), CAST(sum(quantity) AS BIGINT)
        FROM (SELECT quantity FROM lines WHERE NOT is_new
          UNION ALL SELECT quantity FROM new_lines CROSS JOIN verdict WHERE accepted)) AS t
    CROSS JOIN verdict""",
)
def batch_accepted(spark, folder):
    return _state_summary(_applied(spark, folder, merge_lines=True))


@query("batch_accepted_stock", _LINES_SQL + "SELECT * FROM stocked")
def batch_accepted_stock(spark, folder):
    return _applied(spark, folder, merge_lines=True).tables["part"]


@query(
    "batch_rejected",
    _LINES_SQL
    + """SELECT 'part' AS table_name, count(*) AS n_rows, CAST(sum(p_size * 1000) AS BIGINT) AS total,
      FALSE AS accepted FROM part
    UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT), FALSE
      FROM orders WHERE o_orderdate < DATE '2001-01-01'
    UNION ALL SELECT 'lineitem', count(*), CAST(sum(quantity) AS BIGINT), FALSE FROM lines WHERE NOT is_new""",
)
def batch_rejected(spark, folder):
    return _state_summary(_applied(spark, folder, merge_lines=False))


@query(
    "batch_violations",
    _LINES_SQL
    + """SELECT 'lineitem' AS table_name, 'primary_key' AS constraint_name, 'primary_key' AS kind,
      CAST(l_orderkey || '|' || l_linenumber AS VARCHAR) AS "key", count(*) AS n_rows
    FROM lines WHERE is_new GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL SELECT 'part', 'stock_not_negative', 'check', CAST(p_partkey AS VARCHAR), 1
    FROM part JOIN (SELECT l_partkey, sum(quantity) AS taken FROM lines WHERE is_new GROUP BY l_partkey) AS t
      ON p_partkey = l_partkey
    WHERE p_size * 1000 - t.taken < 0""",
)
def batch_violations(spark, folder):
    existing, batch, rules, stock = _recent_batch(spark, folder, merge_lines=False)
    # every rule reads the batch, which is a join over all lines
    batch = {name: land(rows, f"batch-{name}") for name, rows in batch.items()}
    return changes.batch_violations(existing, batch, rules, replace(stock, changes=_stock_taken(batch["lineitem"])))
