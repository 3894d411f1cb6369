"""CSV in and out, with dataframe-library rules for missing values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storefront.functions.missing import nan_to_null, number_text
from storefront.schemas import TableRules

# The texts that count as missing when a CSV is read.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The texts that are read as true or false.
BOOLEAN_TEXTS = ("True", "TRUE", "true", "False", "FALSE", "false")


def _present(name: str) -> Column:
    return F.when(~F.col(name).isin(*MISSING_TEXTS), F.col(name))


def _typed(name: str, dtype: T.DataType | str) -> Column:
    text = _present(name)
    floating = dtype in ("double", T.DoubleType(), T.FloatType())
    return (number_text(text) if floating else text).cast(dtype).alias(name)


# Types from narrow to wide, with the bit that says a value refused the type.
_NARROW = {"boolean": 1, "bigint": 2, "double": 4}


def inferred(raw: DataFrame) -> DataFrame:
    """(column_name, dtype, n_values, refused_boolean, refused_bigint, refused_double) of text columns.

    Each value has the set of types that cannot read it, as bits; the sets of all values of a
    column are merged by OR, in one aggregation over all columns. ``refused_…`` is the least
    value that could not be read so: why a column is no narrower. A column without any value
    counts as double.
    """
    named = [F.col(f"`{c}`") for c in raw.columns]
    long = raw.unpivot([], named, "column_name", "field").select("column_name", _present("field").alias("field"))
    number = number_text(F.col("field"))
    refused = {
        "boolean": ~F.col("field").isin(*BOOLEAN_TEXTS), "bigint": number.try_cast("bigint").isNull(), "double": number.try_cast("double").isNull(),
    }
    bits = reduce(lambda a, b: a.bitwiseOR(b), [F.when(no, _NARROW[t]).otherwise(0) for t, no in refused.items()])
    merged = long.groupBy("column_name").agg(
        F.count("field").alias("n_values"), F.bit_or(F.when(F.col("field").isNotNull(), bits)).alias("bits"),
        *[F.min(F.when(no, F.col("field"))).alias(f"refused_{t}") for t, no in refused.items()],
    )
    fits = lambda t: F.col("bits").bitwiseAND(F.lit(_NARROW[t])) == 0
    dtype = F.when(F.col("n_values") == 0, "double").when(fits("boolean"), "boolean").when(fits("bigint"), "bigint")
    return merged.select(
        "column_name", dtype.when(fits("double"), "double").otherwise("string").alias("dtype"), "n_values", *[f"refused_{t}" for t in refused]
    )


def infer_types(raw: DataFrame) -> dict[str, str]:
    """The narrowest type that reads every field of each text column: a row per column comes in."""
    found = {r.column_name: r.dtype for r in inferred(raw).collect()}
    return {c: found.get(c, "double") for c in raw.columns}


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field goes over several lines: then some line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).limit(1).isEmpty()


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Read CSV files with a header; missing texts become NULL, bad values raise.

    Fields are read as text and cast to ``schema``, so a malformed number fails the
    job instead of turning into a silent NULL. Without a schema the types are found
    first, which costs a scan of its own. ``multi_line`` says whether quoted text holds line
    breaks; a file is then read by one task, else by lines in many. By default the files are
    searched for such a break, in many tasks and only until one is found.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", has_line_breaks(spark, path) if multi_line is None else multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
    )
    if schema is None:
        raw = reader.csv(path)
        types = infer_types(raw)
    else:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        raw = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema])).csv(path)
        types = {f.name: f.dataType for f in schema}
    return nan_to_null(raw.select(*[_typed(name, t) for name, t in types.items()]))


def typed_rows(raw: DataFrame, rules: TableRules) -> DataFrame:
    """Text columns in the declared types of a table, with ``rejects``: what could not be read.

    ``rejects`` is an array of (column_name, field, reason) per row; the row itself has NULL
    there. ``accepted`` and ``rejected`` take the result apart, both from this one scan if it is
    landed. A column that ``raw`` does not have is NULL.
    """
    columns, rejects = [], []
    for f in T.StructType.fromDDL(rules.schema):
        kind = f.dataType.simpleString()
        if f.name not in raw.columns:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = _present(f.name)
        numeric = isinstance(f.dataType, T.NumericType)
        value = (number_text(text) if numeric else text).try_cast(f.dataType)
        columns.append(value.alias(f.name))
        reject = F.struct(F.lit(f.name).alias("column_name"), text.alias("field"), F.lit(f"not {kind}").alias("reason"))
        rejects.append(F.when(text.isNotNull() & value.isNull(), reject))
    return raw.select(*columns, F.array_compact(F.array(*rejects)).alias("rejects"))


def accepted(typed: DataFrame) -> DataFrame:
    """The rows of ``typed_rows`` that could be read whole."""
    return typed.where(F.size("rejects") == 0).drop("rejects")


def rejected(typed: DataFrame, *keys: str) -> DataFrame:
    """(keys, column_name, field, reason) for each field that could not be read."""
    return typed.select(*keys, F.inline("rejects"))


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write ``df`` as CSV part files with a header and no index column."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )
