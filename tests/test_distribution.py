import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from storefront.operators import distribution

SCHEMA = "a DOUBLE, b DOUBLE, c INT, name STRING"


def _table(seed=3, n=2000):
    rng = np.random.default_rng(seed)
    spread = np.concatenate([rng.lognormal(3, 2, n // 2), -rng.exponential(1e-3, n - n // 2)])
    # One value holds more than a third of the rows.
    spread[rng.random(n) < 0.4] = 7.25
    flat = rng.normal(1.7e9, 5, n)
    whole = rng.integers(-50, 50, n)
    return pd.DataFrame({"a": spread, "b": flat, "c": whole})


def _frame(spark, pdf):
    data = [
        (None if i % 7 == 0 else float(r.a), float("nan") if i % 11 == 0 else float(r.b), int(r.c), "x")
        for i, r in enumerate(pdf.itertuples())
    ]
    known = pdf.assign(
        a=[np.nan if d[0] is None else d[0] for d in data], b=[d[1] for d in data]
    )
    return spark.createDataFrame(data, SCHEMA).repartition(7), known


def test_describe_equals_brute_force(spark):
    df, known = _frame(spark, _table())
    expected = known.describe()
    got = {r.column_name: r for r in distribution.describe(df).collect()}
    assert set(got) == {"a", "b", "c"}
    for column, r in got.items():
        assert r["count"] == expected[column]["count"]
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("max", "max"),
                             ("q25", "25%"), ("q50", "50%"), ("q75", "75%")):
            # Deviations around 1.7e9 leave a double about nine sound digits.
            assert r[mine] == pytest.approx(expected[column][theirs], rel=1e-8)


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [0.0] * 9, [1e-300, 1e300, 0.0, -1e300], [0.1 * i for i in range(101)]])
def test_quantiles_of_small_columns(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    wanted = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    r = distribution.quantiles(df, ["v"], wanted).first()
    for name, p in wanted.items():
        assert r[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_describe_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "gone DOUBLE, there DOUBLE")
    got = {r.column_name: r for r in distribution.describe(df).collect()}
    assert got["gone"]["count"] == 0 and got["gone"]["mean"] is None and got["gone"]["q50"] is None
    assert got["there"]["std"] == pytest.approx(math.sqrt(0.5))
    alone = distribution.describe(df.where("there = 1"), ["there"]).first()
    assert alone["count"] == 1 and alone["std"] is None and alone["q25"] == 1.0
    empty = distribution.describe(df.where("there > 9")).collect()
    assert [r["count"] for r in empty] == [0, 0]


@pytest.mark.parametrize("seed", [1, 2])
def test_histogram_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.round(rng.random(3000) * 4.3 + 0.7, 2)
    df = spark.createDataFrame([(float(v),) for v in values], "v DOUBLE").repartition(5)
    counts, edges = np.histogram(values, bins=20)
    got = distribution.histogram(df, "v").orderBy("bin").collect()
    assert [r.n_rows for r in got] == counts.tolist()
    assert [r.bin_from for r in got] == pytest.approx(edges[:-1])
    assert [r.bin_to for r in got] == pytest.approx(edges[1:])


def test_histogram_of_one_value_and_empty_bins(spark):
    df = spark.createDataFrame([(3.0,)] * 4 + [(None,)], "v DOUBLE")
    got = distribution.histogram(df, "v", bins=4).orderBy("bin").collect()
    assert [(r.bin_from, r.n_rows) for r in got] == [(2.5, 0), (2.75, 0), (3.0, 4), (3.25, 0)]


def _box(values):
    q25, q50, q75 = np.quantile(values, [0.25, 0.5, 0.75])
    reach = 1.5 * (q75 - q25)
    inside = values[(values >= q25 - reach) & (values <= q75 + reach)]
    outside = len(values) - len(inside)
    return q25, q50, q75, min(inside.min(), q25), max(inside.max(), q75), outside


@pytest.mark.parametrize(
    "values",
    [
        np.array([1.0, 2, 3, 4, 5]),
        np.array([1.0, 2, 2, 3, 3, 3, 4, 50, -40]),
        np.random.default_rng(5).standard_t(2, 1500),
        np.array([0.0] * 8 + [1.0]),
    ],
)
def test_box_plot_equals_brute_force(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v DOUBLE").repartition(3)
    assert tuple(distribution.box_plot(df, "v").first()) == pytest.approx(_box(values))


def test_whisker_never_ends_inside_the_box(spark):
    # The upper quartile lies between 1 and 100 where no value is within reach.
    values = np.array([0.0, 0, 0, 0, 0, 0, 0, 1, 100, 100])
    df = spark.createDataFrame([(float(v),) for v in values], "v DOUBLE")
    r = distribution.box_plot(df, "v").first()
    assert r.whisker_high >= r.q75 and r.whisker_low <= r.q25


def _scans(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return plan.count("FileScan")


def test_describe_and_box_plot_scan_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50_000).select((F.col("id") % 977 * 1.5).alias("v"), F.col("id").alias("w")).write.parquet(path)
    df = spark.read.parquet(path)
    assert _scans(distribution.describe(df, ["v", "w"])) == 2
    assert _scans(distribution.box_plot(df, "w")) == 2


def test_one_outlier_does_not_widen_what_is_ordered(spark):
    n = 120_000
    df = spark.range(n).select(F.expr("CASE WHEN id = 7 THEN 1e300 ELSE 1e-9 * (id * 7919 % 120000) END").alias("v"))
    summary = distribution._summary(df, ["v"], distribution.QUARTILES)
    counted = distribution._counted(df, ["v"], summary, 3)
    in_parts = distribution._in_parts(counted, summary, distribution.QUARTILES)
    bracket = 2 * (distribution._MARGINS[0] + 1 / distribution._ACCURACY) * n
    assert all(r["count"] <= bracket + 2 for r in in_parts.groupBy("quantile").count().collect())
    ordered = distribution._to_order(in_parts).groupBy("quantile", "part").count().collect()
    assert len(ordered) >= 3
    # a part has a hundredth of the distinct values, and the sketch's error on either side
    assert all(r["count"] <= bracket / distribution._PARTS * 1.5 + 2 for r in ordered)
    r = distribution.quantiles(df, ["v"]).first()
    values = np.array([1e300 if i == 7 else 1e-9 * (i * 7919 % 120_000) for i in range(n)])
    assert [r.q25, r.q50, r.q75] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]), rel=1e-12)


@pytest.mark.parametrize("n", [50, 51, 52, 6_666, 6_667, 6_668, 30_000])
def test_quantiles_around_the_margins(spark, n):
    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.3, 2.5, np.round(rng.standard_cauchy(n), 2))
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(6)
    wanted = {"p0": 0.0, "p1": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    r = distribution.quantiles(df, ["v"], wanted).first()
    assert [r[k] for k in wanted] == pytest.approx(np.quantile(values, list(wanted.values())), rel=1e-12)
    assert tuple(distribution.box_plot(df, "v").first()) == pytest.approx(_box(values))
