"""CSV types and rejects, bound values, and NaN from every source."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from storefront.functions.money import parse_currency
from storefront.operators import aggregate, changes, clean, joins, profile, stats
from storefront.schemas import SHOP
from storefront.sources.csv import accepted, has_line_breaks, inferred, read_csv, rejected, typed_rows, write_csv
from storefront.sources.tables import literal_rows, load, run_sql


def test_one_csv_file_is_read_by_many_tasks(spark, tmp_path):
    file = tmp_path / "in.csv"
    file.write_text("id,t\n" + "".join(f'{i},"a ""quoted"" text, {i}"\n' for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_csv(spark, str(file))
        assert df.rdd.getNumPartitions() > 5 and dict(df.dtypes)["id"] == "bigint"
        assert df.agg(F.sum("id")).first()[0] == sum(range(20_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_breaks_in_fields_are_noticed(spark, tmp_path):
    plain, broken = tmp_path / "plain.csv", tmp_path / "broken.csv"
    plain.write_text('id,t\n1,"says ""hi"""\n2,x\n')
    broken.write_text('id,t\n1,"two\nlines"\n2,x\n')
    assert not has_line_breaks(spark, str(plain)) and has_line_breaks(spark, str(broken))
    assert [r.t for r in read_csv(spark, str(broken)).orderBy("id").collect()] == ["two\nlines", "x"]


def test_inference_says_why_a_column_is_no_narrower(spark, rows):
    raw = spark.createDataFrame(
        [("1", "True", "1", None), ("NA", "no", "2.5", "nan"), ("7", None, "0x1F", "")], "whole STRING, flag STRING, code STRING, none STRING"
    )
    assert rows(inferred(raw)) == sorted(
        [
            ("whole", "bigint", 2, "1", None, None), ("flag", "string", 2, "no", "True", "True"),
            ("code", "string", 3, "0x1F", "0x1F", "0x1F"), ("none", "double", 0, None, None, None),
        ],
        key=repr,
    )
    wide = spark.range(3).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(120)])
    assert {r.dtype for r in inferred(wide).collect()} == {"bigint"}


def test_typed_rows_and_rejects(spark, rows):
    raw = spark.createDataFrame(
        [("1", "7", "2024-02-29", "Pending", "10.50"), ("2", "x7", "2024-02-30", "Lost", "0x1F"), ("3", "", "2024-01-01", "NA", "1e2"), (None, "8", None, None, "9d")],
        "order_id STRING, customer_id STRING, order_date STRING, status STRING, total_amount STRING",
    )
    typed = typed_rows(raw, SHOP["orders"])
    declared = spark.createDataFrame([], SHOP["orders"].schema)
    assert accepted(typed).schema.simpleString() == declared.schema.simpleString()
    assert [(r.order_id, r.customer_id, r.order_date, r.status, float(r.total_amount)) for r in accepted(typed).orderBy("order_id").collect()] == [
        (1, 7, dt.date(2024, 2, 29), "Pending", 10.5), (3, None, dt.date(2024, 1, 1), None, 100.0),
    ]
    assert rows(rejected(typed, "order_id")) == sorted(
        [
            (2, "customer_id", "x7", "not int"), (2, "order_date", "2024-02-30", "not date"),
            (2, "total_amount", "0x1F", "not decimal(12,2)"), (None, "total_amount", "9d", "not decimal(12,2)"),
        ],
        key=repr,
    )
    short = typed_rows(raw.drop("status", "total_amount"), SHOP["orders"]).where("order_id = 1").first()
    assert short.status is None and short.total_amount is None and short.rejects == []
    assert typed_rows(raw.where("false"), SHOP["orders"]).count() == 0


def test_values_are_bound_not_pasted(spark, rows):
    orders = spark.createDataFrame([(1, "it's"), (2, "x' OR '1'='1")], "id INT, note STRING")
    got = run_sql(spark, "SELECT id FROM {o} WHERE note = :note", {"o": orders}, {"note": "x' OR '1'='1"})
    assert rows(got) == [(2,)]


def test_batch_is_dated(spark):
    batch = spark.createDataFrame([(1, dt.date(1999, 1, 1))], "id INT, came DATE")
    assert changes.dated(batch, "came", dt.date(2024, 5, 1)).first().came == dt.date(2024, 5, 1)
    today = changes.dated(batch.drop("came"), "came").select("came", F.current_date().alias("now")).first()
    assert today.came == today.now


def test_nan_is_missing_from_every_source(spark, tmp_path, rows):
    data = [("a", float("nan"), 1.0), ("a", 2.0, 2.0), ("b", 4.0, float("nan")), ("b", 6.0, 1.0), ("c", float("nan"), 9.0)]
    schema = "k STRING, x DOUBLE, y DOUBLE"
    frame = spark.createDataFrame(data, schema)
    frame.write.parquet(f"{tmp_path}/t.parquet")
    write_csv(frame, f"{tmp_path}/t.csv")
    sources = {
        "frame": frame, "parquet": load(spark, str(tmp_path), "t"), "literal": literal_rows(spark, data, schema),
        "sql": run_sql(spark, "SELECT * FROM {t}", {"t": frame}), "csv": read_csv(spark, f"{tmp_path}/t.csv", schema),
    }
    known = pd.DataFrame(data, columns=["k", "x", "y"])
    for name, df in sources.items():
        assert [(r.k, r["mean"]) for r in aggregate.top_k_by_mean(df, "k", "x").collect()] == [("b", 5.0), ("a", 2.0), ("c", None)], name
        assert sorted(tuple(r) for r in profile.value_counts(df, "x").collect()) == [(2.0, 1), (4.0, 1), (6.0, 1)], name
        assert stats.correlation(df, "x", "y").first()[0] == pytest.approx(known["x"].corr(known["y"])), name
        if name != "frame":
            assert df.where("x IS NULL").count() == 2, name


def test_price_texts_in_other_notations_are_no_prices(spark):
    df = spark.createDataFrame([("0x1p3",), ("12f",), ("1_000",), ("Infinity",), (" 5. ",), (".5",), ("+1e2",)], "t STRING")
    got = [r[0] for r in df.select(parse_currency("t", strict=False)).collect()]
    assert got == [None, None, None, float("inf"), 5.0, 0.5, 100.0]


def test_copies_by_digest(spark):
    data = [(1.0, "a", None), (1.0, "a", None), (-0.0, "z", 1), (0.0, "z", 1), (float("nan"), None, 2), (float("nan"), None, 2), (None, "a", 1), (1.0, None, None)]
    df = spark.createDataFrame(data, "x DOUBLE, y STRING, `odd name` INT").repartition(4)
    assert clean.duplicate_count(df).first()[0] == 3
    kept = clean.drop_duplicates(df)
    assert kept.count() == 5 and kept.columns == df.columns
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, df.dropDuplicates().collect()))


def test_only_digests_of_unlike_rows_are_shuffled(spark, tmp_path):
    df = spark.range(4_000).select("id", F.expr("repeat(md5(cast(id as string)), 30)").alias("text"))
    df.unionAll(df.where("id < 5")).repartition(4).write.parquet(f"{tmp_path}/t")
    counted = clean.duplicate_count(spark.read.parquet(f"{tmp_path}/t"))
    assert counted.first()[0] == 5
    plan = counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("__digest" in line for line in moved) and not any("id" in line and "__digest" in line.replace("plan_id", "") and "text" in line for line in moved)


def test_wide_correlation_matrix(spark):
    rng = np.random.default_rng(6)
    known = pd.DataFrame(rng.normal(size=(150, 60)), columns=[f"c{i}" for i in range(60)])
    known["c1"] += known["c0"]
    known = known.mask(rng.random(known.shape) < 0.2)
    known["c59"] = np.nan
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in r) for r in known.itertuples(index=False)], ", ".join(f"{c} DOUBLE" for c in known))
    got = {(r.var_a, r.var_b): r["corr"] for r in stats.correlation_matrix(df, list(known)).collect()}
    want = known.corr()
    assert len(got) == 3600
    for (a, b), r in got.items():
        assert (r is None and pd.isna(want.loc[a, b])) or r == pytest.approx(want.loc[a, b]), (a, b)


def test_outer_join_takes_shared_names(spark, rows):
    left = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (None, "n", 7)], "k INT, name STRING, v INT")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k INT, name STRING")
    got = joins.outer_join(left, right, "k", "full", side="side")
    assert got.columns == ["k", "name_left", "v", "name_right", "side"]
    assert rows(got) == sorted(
        [
            (1, "a", 5, "x", "both"), (2, "b", 6, None, "left_only"), (None, "n", 7, None, "left_only"),
            (3, None, None, "y", "right_only"), (None, None, None, "z", "right_only"),
        ],
        key=repr,
    )


def test_outer_join_shuffles_the_rows_of_a_side_once(spark, tmp_path):
    spark.range(3_000).select((F.col("id") % 700).alias("k"), F.col("id").alias("l")).write.parquet(f"{tmp_path}/l")
    spark.range(3_000).select((F.col("id") % 900 + 100).alias("k"), F.col("id").alias("r")).write.parquet(f"{tmp_path}/r")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.outer_join(spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r"), "k", "full")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(moved) == 4  # the rows of each side, and its distinct keys
    assert plan.count("ReusedExchange") == 2


def test_key_audit(spark, rows):
    left = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (None, 4)], "k INT, v INT")
    right = spark.createDataFrame([(1,), (3,), (None,)], "k INT")
    assert rows(joins.key_audit(left, right, "k")) == sorted(
        [(1, 2, 1, "both"), (2, 1, 0, "left_only"), (3, 0, 1, "right_only"), (None, 1, 1, "no_key")], key=repr
    )
