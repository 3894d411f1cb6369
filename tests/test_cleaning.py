import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from storefront.functions.bands import price_tier, range_label
from storefront.functions.dates import between_days, in_year, on_day
from storefront.functions.missing import nan_to_null
from storefront.functions.money import mean, parse_currency
from storefront.operators import clean, derive, profile
from storefront.plans.listing import clean_listing, featured_listing


def test_fill_missing_leaves_nothing_missing(spark):
    df = spark.createDataFrame(
        [(None, None, "a"), (float("nan"), "", None), (3.5, "kept", None)],
        "discount DOUBLE, seller STRING, other STRING",
    )
    filled = clean.fill_missing(df, numbers=["discount"], texts=["seller"])
    assert [tuple(r) for r in filled.collect()] == [
        (0.0, "Not Available", "a"), (0.0, "", None), (3.5, "kept", None),
    ]
    missing = {r.column_name: r.missing for r in profile.missing_counts(filled).collect()}
    assert missing == {"discount": 0, "seller": 0, "other": 2}


def test_duplicates_count_missing_as_equal(spark):
    data = [(1, "a"), (1, "a"), (1, None), (1, None), (None, None), (None, None), (2, "b")]
    df = spark.createDataFrame(data, "k INT, v STRING")
    kept = clean.drop_duplicates(df)
    assert clean.duplicate_count(df).first()[0] == 3 == df.count() - kept.count()
    assert clean.duplicate_count(df, ["k"]).first()[0] == 4
    assert clean.duplicate_count(df.where("k > 9")).first()[0] == 0


def test_parse_currency(spark):
    texts = ['"₹1,299"', "\t₹ 2,50,000.50  ", "17", None, "nan", "n/a", "12d", "1e3"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    lenient = df.select("i", parse_currency("t", strict=False).alias("x")).orderBy("i").collect()
    assert [r.x for r in lenient] == [1299.0, 250000.5, 17.0, None, None, None, None, 1000.0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(parse_currency("t")).collect()
    assert df.where("i < 5").select(parse_currency("t").alias("x")).where("x > 0").count() == 3


def test_range_label_edges(spark):
    values = [0.0, 0.1, 2.0, 2.5, 3.0, 4.0, 5.0, 5.1, -1.0, None, float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v DOUBLE")
    got = [r[0] for r in df.orderBy("i").select(range_label("v")).collect()]
    cut = pd.cut(pd.Series(values, dtype=float), [0, 2, 3, 4, 5], labels=["0-2", "2-3", "3-4", "4-5"])
    assert got == [None if pd.isna(c) else c for c in cut]
    with pytest.raises(ValueError):
        range_label("v", (0, 1), ("a", "b"))


def test_price_tier_bounds(spark):
    df = spark.createDataFrame([(999.99,), (1000.0,), (5000.0,), (5000.01,), (None,)], "p DOUBLE")
    got = [r[0] for r in df.select(price_tier("p")).collect()]
    assert got == ["Budget", "Mid-Range", "Mid-Range", "Premium", "Premium"]


def test_date_ranges_take_whole_days(spark):
    stamps = ["2024-08-09 23:59:59", "2024-08-10 00:00:00", "2024-08-25 23:59:59", "2024-08-26 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "t STRING").select(
        F.col("t").cast("timestamp_ntz").alias("t"), F.col("t").cast("date").alias("d")
    )
    first, last = dt.date(2024, 8, 10), dt.date(2024, 8, 25)
    for column in ("t", "d"):
        assert df.where(between_days(column, first, last)).count() == 2
        assert df.where(on_day(column, last)).count() == 1
        assert df.where(in_year(column, 2024)).count() == 4
        assert df.where(in_year(column, 2023)).count() == 0


def test_year_range_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = orders.where(in_year("o_orderdate", 1997))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x DECIMAL(12,2)")
    assert df.agg(mean("x")).first()[0] is None
    assert spark.sql("SELECT CAST(x AS DECIMAL(12,2)) AS x FROM VALUES (1.10), (2.20), (NULL) t(x)").agg(
        mean("x")
    ).first()[0] == 1.65


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1, "nan")], "a DOUBLE, b INT, c STRING")
    assert tuple(nan_to_null(df).first()) == (None, 1, "nan")


def test_listing_flow(spark):
    data = [
        (1, "shirt", 4.5, 10, 500.0, None, '"₹1,299"', None),
        (1, "shirt", 4.5, 10, 500.0, None, '"₹1,299"', None),
        (2, "boots", 0.0, 0, 900.0, 10.0, "₹899", "ann"),
    ]
    raw = spark.createDataFrame(
        data,
        "product_id INT, title STRING, rating DOUBLE, ratings_count BIGINT, initial_price DOUBLE, "
        "discount DOUBLE, final_price STRING, seller_name STRING",
    )
    cleaned = clean_listing(raw, texts=("seller_name",))
    assert dict(cleaned.dtypes)["final_price"] == "string"
    first, second = featured_listing(cleaned).orderBy("product_id").collect()
    assert (first.discount, first.seller_name, first.quantity, first.total_amount) == (0.0, "Not Available", 1, 500.0)
    assert (first.final_price, first.price_difference, first.popularity_score) == (1299.0, -799.0, 45.0)
    assert second.popularity_score == 0.0


def test_total_follows_quantity(spark):
    df = spark.createDataFrame([(2.5,), (None,)], "initial_price DOUBLE")
    assert [r.total_amount for r in derive.add_totals(df, quantity=4).collect()] == [10.0, None]
