import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from storefront.operators import changes, quality
from storefront.schemas import CUSTOMERS, SHOP, ForeignKey, TableRules
from storefront.sources.tables import write_state

DAY = dt.date(2024, 5, 1)


def D(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


@pytest.fixture(scope="module")
def shop(spark):
    data = {
        "customers": [
            (1, "Ana", "Lee", "ana@x", "Goa", "GA", DAY, True),
            (2, "Bo", "Ray", "bo@x", "Pune", "MH", DAY, None),
        ],
        "products": [(10, "Lamp", "Home", "Glow", D(1200), 5), (11, "Mug", "Home", "Clay", D(90), 2)],
        "orders": [(100, 1, DAY, "Delivered", D(1200)), (101, 2, DAY, "Pending", D(90))],
        "order_items": [(1000, 100, 10, 1, D(1200), D(0)), (1001, 101, 11, 1, D(90), None)],
    }
    return {n: spark.createDataFrame(rows, SHOP[n].schema) for n, rows in data.items()}


def test_sound_tables_give_an_empty_report(shop):
    assert quality.violation_report(shop, SHOP).count() == 0


def test_report_finds_each_kind(spark, shop):
    bad = dict(shop)
    bad["customers"] = shop["customers"].unionByName(
        spark.createDataFrame(
            [(2, "Cy", None, "ana@x", "Agra", "UP", DAY, False), (None, "Di", "Fo", "di@x", "Agra", "UP", DAY, None)],
            CUSTOMERS.schema,
        )
    )
    bad["products"] = shop["products"].unionByName(
        spark.createDataFrame([(12, "Test", "Home", "T", D(-50), 10)], SHOP["products"].schema)
    )
    bad["orders"] = shop["orders"].unionByName(
        spark.createDataFrame(
            [(102, 999, DAY, "Lost", D(1)), (103, 999, DAY, "Pending", D(1))], SHOP["orders"].schema
        )
    )
    found = sorted(tuple(r) for r in quality.violation_report(bad, SHOP).collect())
    assert found == [
        ("customers", "email_unique", "unique", "ana@x", 2),
        ("customers", "last_name_not_null", "not_null", "2", 1),
        ("customers", "primary_key", "primary_key", "2", 2),
        ("customers", "primary_key", "primary_key", "NULL", 1),
        ("orders", "customer_id_to_customers", "foreign_key", "999", 2),
        ("orders", "status_known", "check", "102", 1),
        ("products", "unit_price_positive", "check", "12", 1),
    ]


def test_null_rules(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", None), ("b", -1)], "u STRING, n INT")
    assert rows(quality.unique_violations(df, ["u"])) == [("a", 2)]
    assert rows(quality.primary_key_violations(df, ["u"])) == [("a", 2), (None, 2)]
    assert rows(quality.check_violations(df, "n > 0")) == [("b", -1)]
    assert rows(quality.check_violations(df, F.col("u").isin("a"))) == [("b", -1)]
    assert rows(quality.not_null_violations(df, ["u", "n"])) == [("n", 1), ("u", 2)]


def test_defaults_fill_only_absent_columns(spark, shop):
    batch = spark.createDataFrame(
        [(3, "Ed", "Poe", "ed@x", "Goa", "GA", DAY)],
        "customer_id INT, first_name STRING, last_name STRING, email STRING, city STRING, state STRING, join_date DATE",
    )
    done = changes.with_defaults(batch, shop["customers"], CUSTOMERS.defaults)
    assert done.columns == shop["customers"].columns and done.first().is_premium is False
    stated = batch.withColumn("is_premium", F.lit(None).cast("boolean"))
    assert changes.with_defaults(stated, shop["customers"], CUSTOMERS.defaults).first().is_premium is None
    assert changes.append_rows(shop["customers"], batch, CUSTOMERS.defaults).count() == 3
    with pytest.raises(ValueError):
        changes.with_defaults(batch.withColumn("nick", F.lit("x")), shop["customers"], {})


def test_stock_changes_add_up(spark, shop, rows):
    sold = spark.createDataFrame([(10, 1), (10, 3), (77, 5)], "product_id INT, quantity INT")
    after = changes.subtract_stock(shop["products"], sold)
    assert rows(after, "product_id", "stock_qty") == [(10, 1), (11, 2)]
    assert after.schema["stock_qty"].dataType.simpleString() == "int"


def _batch(spark, customer=2, items=((1002, 10, 2), (1003, 10, 1)), order=102, taken=None):
    orders = spark.createDataFrame(
        [(order, customer, DAY, D(3600))], "order_id INT, customer_id INT, order_date DATE, total_amount DECIMAL(12,2)"
    )
    lines = spark.createDataFrame(
        [(i, order, p, q, D(1200)) for i, p, q in items],
        "item_id INT, order_id INT, product_id INT, quantity INT, unit_price DECIMAL(10,2)",
    )
    stock = lines if taken is None else spark.createDataFrame(taken, "product_id INT, quantity INT")
    return {"orders": orders, "order_items": lines}, changes.StockUpdate("products", stock.select("product_id", "quantity"))


@pytest.mark.parametrize("durable", [True, False])
def test_sound_batch_is_applied_whole(spark, shop, rows, durable):
    batch, stock = _batch(spark)
    result = changes.apply_batch(shop, batch, SHOP, stock, durable=durable)
    assert tuple(result.verdict.first()) == (True, 0)
    assert result.tables["orders"].count() == 3 and result.tables["order_items"].count() == 4
    assert rows(result.tables["products"], "product_id", "stock_qty") == [(10, 2), (11, 2)]
    assert result.tables["orders"].where("order_id = 102").first().status == "Pending"
    assert result.tables["customers"] is shop["customers"]


@pytest.mark.parametrize(
    "changed, constraint",
    [
        ({"customer": 999}, "customer_id_to_customers"),
        ({"order": 100}, "primary_key"),
        ({"items": ((1002, 10, 1), (1002, 11, 1))}, "primary_key"),
        ({"items": ((1000, 10, 1),)}, "primary_key"),
        ({"items": ((1002, 10, 0),)}, "quantity_positive"),
        ({"items": ((1002, 99, 1),)}, "product_id_to_products"),
        ({"items": ((1002, None, 1),)}, "product_id_not_null"),
        ({"items": ((1002, 10, 4), (1003, 10, 2))}, "stock_not_negative"),
    ],
)
def test_one_bad_row_leaves_the_state_unchanged(spark, shop, rows, changed, constraint):
    batch, stock = _batch(spark, **changed)
    result = changes.apply_batch(shop, batch, SHOP, stock)
    verdict = result.verdict.first()
    assert verdict.accepted is False and verdict.n_violations == 1
    assert [r.constraint_name for r in result.violations.collect()] == [constraint]
    for name, df in shop.items():
        assert rows(result.tables[name]) == rows(df)


def test_batch_judges_only_what_it_touches(spark, shop):
    # The existing tables hold an orphan and a repeated key; the batch meets neither.
    spoiled = dict(shop)
    spoiled["orders"] = shop["orders"].unionByName(
        spark.createDataFrame([(101, 555, DAY, "Pending", D(1))], SHOP["orders"].schema)
    )
    batch, stock = _batch(spark)
    assert changes.apply_batch(spoiled, batch, SHOP, stock).verdict.first().accepted is True


def test_batch_may_bring_its_own_parents(spark, shop, rows):
    batch, _ = _batch(spark, customer=3, items=((1002, 12, 1),))
    batch["customers"] = spark.createDataFrame(
        [(3, "Ed", "Poe", "ed@x", "Goa", "GA", DAY, None)], CUSTOMERS.schema
    )
    batch["products"] = spark.createDataFrame(
        [(12, "Pan", "Home", "Iron", D(700), 1)], SHOP["products"].schema
    )
    stock = changes.StockUpdate("products", batch["order_items"].select("product_id", "quantity"))
    result = changes.apply_batch(shop, batch, SHOP, stock)
    assert result.verdict.first().accepted is True
    assert rows(result.tables["products"], "product_id", "stock_qty") == [(10, 5), (11, 2), (12, 0)]


def test_update_of_unknown_product_changes_nothing(spark, shop, rows):
    batch, stock = _batch(spark, taken=[(77, 3)])
    result = changes.apply_batch(shop, batch, SHOP, stock)
    assert result.verdict.first().accepted is True
    assert rows(result.tables["products"]) == rows(shop["products"])


def test_batch_email_clash_with_existing_rows(spark, shop):
    batch = {
        "customers": spark.createDataFrame(
            [(9, "Test", "User", "ana@x", "Goa", "GA", DAY)],
            "customer_id INT, first_name STRING, last_name STRING, email STRING, city STRING, state STRING, join_date DATE",
        )
    }
    result = changes.apply_batch(shop, batch, SHOP)
    assert [tuple(r) for r in result.violations.collect()] == [("customers", "email_unique", "unique", "ana@x", 1)]


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_report_reads_each_table_once_and_shuffles_once(spark, shop, tmp_path):
    stored = {}
    for name, df in shop.items():
        df.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = _final_plan(quality.violation_report(stored, SHOP))
    assert plan.count("FileScan") == len(SHOP)
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_report_groups_by_plain_columns(spark, shop):
    # an array of texts as a key costs time with every row
    plan = _final_plan(quality.violation_report(shop, SHOP))
    grouped = [line for line in plan.splitlines() if "Aggregate(keys=" in line]
    assert grouped and all("keys=[tag" in line and "parts" not in line for line in grouped)


def test_keys_of_a_batch_meet_over_all_partitions(spark, rows):
    # few bytes can be many rows: partitions that look small must not be merged into one task
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        existing, batch = spark.range(1000), spark.createDataFrame([(5,), (5,), (7,), (2000,), (None,)], "id BIGINT")
        met = changes._meeting(existing, quality.key_counts(batch, ["id"]), ["id"])
        assert rows(met) == [(5,), (7,)] and met.rdd.getNumPartitions() > 8
        report = changes._key_report(existing, batch, "t", ["id"], primary=True)
        assert rows(report, "key", "n_rows") == [("5", 2), ("7", 1), ("NULL", 1)]
        assert "LeftOuter" not in _final_plan(report)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_report_keeps_typed_keys_apart(spark, rows):
    parent = TableRules("parent", primary_key=("a", "b"), schema="a STRING, b STRING")
    child = TableRules(
        "child", primary_key=("id",), foreign_keys=(ForeignKey(("x", "y"), "parent", ("a", "b")), ForeignKey(("n",), "number", ("n",), "ok"))
    )
    number = TableRules("number", primary_key=("n",))
    tables = {
        "parent": spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("NULL", "z"), (None, "z"), ("p\\", "q"), ("p", "\\q")], "a STRING, b STRING"),
        "child": spark.createDataFrame(
            [(1, "a|b", "c", 1), (2, "a", "b|c", 2), (3, "NULL", "z", 3), (4, None, "z", None), (5, "a", "b", 1), (5, "a", "b", 1)],
            "id INT, x STRING, y STRING, n INT",
        ),
        # the same numbers in another type; a row that does not count is no parent
        "number": spark.createDataFrame([(1.0, True), (2.0, False), (-0.0, True), (0.0, True), (9.0, None)], "n DOUBLE, ok BOOLEAN"),
    }
    got = rows(quality.violation_report(tables, {"parent": parent, "child": child, "number": number}))
    assert got == sorted(
        [
            ("parent", "primary_key", "primary_key", "NULL|z", 1),
            ("child", "primary_key", "primary_key", "5", 2),
            ("child", "x_y_to_parent", "foreign_key", "a|b", 2),
            ("child", "n_to_number", "foreign_key", "2.0", 1),
            ("child", "n_to_number", "foreign_key", "3.0", 1),
            ("number", "primary_key", "primary_key", "0.0", 2),
        ],
        key=repr,
    )
    texts = {r[0] for r in tables["parent"].select(quality.key_text(["a", "b"])).collect()}
    assert len(texts) == 6 and {"a\\|b|c", "a|b\\|c", "\\NULL|z", "NULL|z"} <= texts


def test_orphans_in_one_aggregation(spark, rows):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k INT")
    parent = spark.createDataFrame([(1, "x")] * 50 + [(3, "y"), (None, "x")], "id BIGINT, kind STRING")
    link = ForeignKey(("k",), "parent", ("id",), where="kind = 'x'")
    found = quality.orphans(child, link, parent)
    assert rows(found) == [(2, 1), (3, 1)] and found.schema["k"].dataType.simpleString() == "int"
    assert "Join" not in _final_plan(found)


def test_verdict_comes_from_the_writes(spark, shop, tmp_path):
    batch, stock = _batch(spark)
    result = changes.apply_batch(shop, batch, SHOP, stock)
    assert "Scan" not in _final_plan(result.verdict).replace("Range", "")
    assert len(result.scratch) == 4  # the two tables, the stock changes, the violations: nothing of the base
    folders = [Path(p.removeprefix("file:")) for p in result.scratch]
    assert all(f.exists() for f in folders)
    write_state(result.tables, f"{tmp_path}/next")
    result.remove_scratch()
    assert not any(f.exists() for f in folders)
    refused, stock = _batch(spark, customer=999)
    result = changes.apply_batch(shop, refused, SHOP, stock)
    assert all(result.tables[n] is shop[n] for n in shop)


@pytest.mark.parametrize("durable", [True, False])
def test_change_without_quantity_is_refused(spark, shop, durable):
    batch, stock = _batch(spark, taken=[(10, 1), (10, None)])
    result = changes.apply_batch(shop, batch, SHOP, stock, durable=durable)
    assert result.verdict.first().accepted is False
    assert [tuple(r) for r in result.violations.collect()] == [("products", "quantity_not_null", "not_null", "10", 1)]
    with pytest.raises(Exception, match="without quantity"):
        changes.subtract_stock(shop["products"], stock.changes).collect()


def test_stock_columns_may_be_called_taken(spark):
    products = spark.createDataFrame([(1, 5, "x")], "product_id INT, stock_qty INT, taken STRING")
    sold = spark.createDataFrame([(1, 2, "y")], "product_id INT, quantity INT, _taken STRING")
    assert [tuple(r) for r in changes.subtract_stock(products, sold).collect()] == [(1, 3, "x")]
