import datetime as dt
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from storefront.operators import aggregate, joins, profile, stats
from storefront.schemas import CUSTOMERS, LISTING_SCHEMA, SHOP
from storefront.session import land, scratch_path, shared_folder
from storefront.sources.csv import read_csv, write_csv
from storefront.sources.tables import empty_tables, literal_rows, load, register_views, run_sql, write_state


def test_csv_keeps_text_and_types(spark, tmp_path):
    schema = "id INT, t STRING, x DOUBLE, d DATE, ok BOOLEAN, m DECIMAL(12,2)"
    data = [
        (1, 'two\nlines, "quoted" \\ ₹', 0.1, dt.date(2024, 2, 29), True, None),
        (2, None, None, None, None, None),
        (3, " padded ", -1e300, dt.date(1999, 1, 1), False, None),
    ]
    df = spark.createDataFrame(data, schema)
    path = str(tmp_path / "out")
    write_csv(df, path)
    assert sorted(map(tuple, read_csv(spark, path, schema).collect())) == sorted(data)
    inferred = read_csv(spark, path).orderBy("id")
    assert dict(inferred.dtypes)["x"] == "double" and inferred.count() == 3


def test_csv_missing_texts_and_bad_values(spark, tmp_path):
    file = tmp_path / "in.csv"
    file.write_text('id,name,x\n1,NA,nan\n2,"n/a",\n3,Ann,2.5\n')
    got = read_csv(spark, str(file), "id INT, name STRING, x DOUBLE").orderBy("id").collect()
    known = pd.read_csv(file)
    for mine, (_, theirs) in zip(got, known.iterrows()):
        for column in known.columns:
            assert (mine[column] is None) == pd.isna(theirs[column])
    for bad in ("oops", "12d"):
        file.write_text(f"id,name,x\n1,a,{bad}\n")
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            read_csv(spark, str(file), "id INT, name STRING, x DOUBLE").collect()


def test_csv_types_are_found(spark, tmp_path):
    file = tmp_path / "in.csv"
    file.write_text(
        "whole,part,code,flag,text,none,mixed\n"
        "1,1.5,12d,True,a,,1\nNA,2,7,False,,nan,x\n-3,1e3,8f,,NA,,2\n+4,-.5,9,TRUE,b,null,3\n"
    )
    df = read_csv(spark, str(file))
    assert dict(df.dtypes) == {
        "whole": "bigint", "part": "double", "code": "string", "flag": "boolean",
        "text": "string", "none": "double", "mixed": "string",
    }
    assert sorted(r.whole for r in df.collect() if r.whole is not None) == [-3, 1, 4]
    known = pd.read_csv(file)
    assert {r.column_name: r.missing for r in profile.missing_counts(df).collect()} == known.isnull().sum().to_dict()


def test_listing_schema_reads(spark, tmp_path):
    file = tmp_path / "listing.csv"
    names = [c.split()[0] for c in LISTING_SCHEMA.split(", ")]
    file.write_text(",".join(names) + '\np1,shirt,tops,4.5,12,799,,"₹1,299",good,,,,\n')
    r = read_csv(spark, str(file), LISTING_SCHEMA).first()
    assert (r.final_price, r.discount, r.ratings_count, r.seller_name) == ("₹1,299", None, 12, None)


def test_literal_rows_and_sql(spark):
    rows = [(1, "Ana", "Lee", "a@x", "Goa", "GA", dt.date(2024, 1, 1), None)]
    df = literal_rows(spark, rows, CUSTOMERS.schema)
    assert df.schema["join_date"].dataType.simpleString() == "date"
    assert run_sql(spark, "SELECT first_name FROM {people} WHERE is_premium IS NULL", {"people": df}).first()[0] == "Ana"
    register_views({"people_view": df})
    assert spark.sql("SELECT count(*) FROM people_view").first()[0] == 1
    with pytest.raises(Exception):
        literal_rows(spark, [("one",)], "n INT")


def test_state_is_never_overwritten(spark, tmp_path):
    df = spark.range(3)
    write_state({"numbers": df}, str(tmp_path))
    assert load(spark, str(tmp_path), "numbers").count() == 3
    with pytest.raises(Exception, match="already exists"):
        write_state({"numbers": df}, str(tmp_path))


def test_land_reads_back_the_same(spark):
    df = spark.range(5).withColumn("r", F.rand())
    kept = land(df, "test")
    assert sorted(kept.collect()) == sorted(kept.collect())
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def _session(folder, master):
    """As much of a session as the choice of a folder needs."""
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)


def test_scratch_lies_in_the_folder_the_session_names():
    assert scratch_path(_session("hdfs://shared/", "yarn"), "x").startswith("hdfs://shared/x-")
    assert shared_folder(_session(None, "local[2]")) == shared_folder(_session(None, "local[2]"))
    for master in ("yarn", "local-cluster[3,2,1000]", "spark://head:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(_session(None, master))


def test_shape_profile_and_counts(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (2, 1.0, "x")], "a INT, b DOUBLE, c STRING")
    assert tuple(profile.shape(df).first()) == (2, 3)
    assert [tuple(r) for r in profile.column_profile(df).collect()] == [
        (0, "a", "int", 2, 0), (1, "b", "double", 1, 1), (2, "c", "string", 1, 1),
    ]
    counts = profile.table_counts({"one": df, "none": df.where("a > 9")})
    assert sorted(map(tuple, counts.collect())) == [("none", 0), ("one", 2)]


def test_head_tail_and_value_counts(spark):
    df = spark.range(20).withColumn("v", F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 3)))
    assert [r.id for r in profile.head(df, "id").collect()] == [0, 1, 2, 3, 4]
    assert [r.id for r in profile.tail(df, "id", 2).collect()] == [19, 18]
    assert [tuple(r) for r in profile.value_counts(df, "v").collect()] == [("k1", 7), ("k2", 6)]


def test_top_k_breaks_ties_by_key(spark):
    data = [(f"c{i:02d}", 5.0) for i in range(12)] + [("best", 9.0), (None, 99.0), ("none", None)]
    df = spark.createDataFrame(data, "category STRING, price DOUBLE").repartition(4)
    top = aggregate.top_k_by_mean(df, "category", "price")
    assert [r.category for r in top.collect()] == ["best"] + [f"c{i:02d}" for i in range(9)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert aggregate.top_k_by_mean(df, "category", "price", k=20).collect()[-1].category == "none"
    assert [r.category for r in aggregate.top_k_by_count(df, "category", 2).collect()] == ["best", "c00"]


def test_split_count_and_totals(spark):
    df = spark.createDataFrame([("D", 2.0), ("D", 3.0), ("P", 9.0), (None, 1.0)], "s STRING, x DOUBLE")
    assert tuple(aggregate.split_count(df, "s", "D", "yes", "no").first()) == (2, 1)
    assert tuple(aggregate.split_count(df.where("x > 99"), "s", "D", "yes", "no").first()) == (None, None)
    assert [tuple(r) for r in aggregate.totals_by(df, "s", "x").collect()] == [("P", 1, 9.0), ("D", 2, 5.0), (None, 1, 1.0)]


def test_mean_by_band_keeps_empty_bands(spark):
    df = spark.createDataFrame([(0.0, 7.0), (1.0, 2.0), (2.0, 4.0), (4.5, None), (9.0, 1.0)], "r DOUBLE, p DOUBLE")
    got = [tuple(r) for r in aggregate.mean_by_band(df, "r", "p").collect()]
    assert got == [("0-2", 3.0), ("2-3", None), ("3-4", None), ("4-5", None)]


def test_correlation_skips_missing_pairs(spark):
    data = [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (4.0, None), (None, 8.0)]
    df = spark.createDataFrame(data, "a DOUBLE, b DOUBLE")
    known = pd.DataFrame(data, columns=["a", "b"], dtype=float).corr()
    assert stats.correlation(df, "a", "b").first()[0] == pytest.approx(known.loc["a", "b"])
    matrix = {(r.var_a, r.var_b): r["corr"] for r in stats.correlation_matrix(df, ["a", "b"]).collect()}
    assert matrix == {(x, y): pytest.approx(known.loc[x, y]) for x in "ab" for y in "ab"}


LEFT = [(1, "a"), (2, "b"), (None, "c"), (3, "d")]
RIGHT = [(1, 10), (1, 11), (4, 12), (None, 13)]


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_join_equals_plain_join(spark, rows, how):
    left = spark.createDataFrame(LEFT, "k INT, l STRING")
    right = spark.createDataFrame(RIGHT, "k INT, r INT")
    assert rows(joins.outer_join(left, right, "k", how), "k", "l", "r") == rows(left.join(right, "k", how), "k", "l", "r")


def test_audit_tells_sides_and_anti_completes_semi(spark, rows):
    left = spark.createDataFrame(LEFT, "k INT, l STRING")
    right = spark.createDataFrame(RIGHT, "k INT, r INT")
    audit = joins.outer_join(left, right, "k", "full", side="side")
    assert {r.side: r["count"] for r in audit.groupBy("side").count().collect()} == {
        "both": 2, "left_only": 3, "right_only": 2,
    }
    matched = left.join(right, "k", "left_semi")
    assert rows(matched.unionByName(joins.without_match(left, right, "k"))) == rows(left)
    with pytest.raises(ValueError):
        joins.outer_join(left, right, "k", "inner")


def test_shop_rules_name_their_own_columns(spark):
    tables = empty_tables(spark, SHOP)
    for name, rules in SHOP.items():
        empty = tables[name]
        named = set(rules.primary_key) | set(rules.not_null) | set(rules.defaults)
        assert named <= set(empty.columns)
        for predicate in rules.checks.values():
            empty.where(predicate)
