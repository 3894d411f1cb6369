"""Constraint checks over whole tables.

A check never looks at rows one by one: keys are counted on the map side before they are
shuffled. The report reads every table once and shuffles once: each row gives its keys,
tagged with the key they are (of which table and columns), and each foreign key's value,
tagged with the key it must be. One aggregation then holds, for every key, how many rows own
it and how many refer to it, so an orphan is a key without an owner. Rows that break a rule of
their own come along under a tag of that rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storefront.schemas import ForeignKey, TableRules

REPORT_COLUMNS = ("table_name", "constraint_name", "kind", "key", "n_rows")


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _written(part: Column) -> Column:
    """A part of a key as text: ``|`` and ``\\`` are escaped, and the text NULL is no NULL."""
    escaped = F.regexp_replace(part, r"([|\\])", r"\\$1")
    return F.when(part == "NULL", F.lit("\\NULL")).otherwise(F.coalesce(escaped, F.lit("NULL")))


def key_text(columns: Sequence[str]) -> Column:
    """The key of a row as one text, NULL parts written out; unlike keys have unlike texts."""
    return F.concat_ws("|", *[_written(_part(F.col(c))) for c in columns])


def _part(value: Column, dtype: T.DataType | None = None) -> Column:
    """A part of a key as text; equal numbers are equal texts."""
    value = value.cast(dtype) if dtype is not None else value
    zero = isinstance(dtype, (T.DoubleType, T.FloatType))
    return (value + F.lit(0.0).cast(dtype) if zero else value).cast("string")


def key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each key with the number of its rows, NULL keys included."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows"))


def primary_key_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or have a NULL part."""
    return key_counts(df, columns).where((F.col("n_rows") > 1) | ~_all_present(columns))


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULLs never collide."""
    return key_counts(df.where(_all_present(columns)), columns).where(F.col("n_rows") > 1)


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_rows) for the columns that have NULLs, all in one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_rows")) for i, c in enumerate(columns)]
    )
    return counted.select(F.inline(rows)).where("n_rows > 0")


def breaks(predicate: str | Column) -> Column:
    """True where a CHECK predicate is false; a predicate that is NULL passes."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return ~F.coalesce(p, F.lit(True))


def check_violations(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Rows that break a CHECK predicate."""
    return df.where(breaks(predicate))


def _common_types(a: DataFrame, b: DataFrame) -> list[T.DataType]:
    """The types in which the columns of both can be compared, as UNION finds them."""
    return [f.dataType for f in a.unionAll(b).schema]


def orphans(child: DataFrame, link: ForeignKey, parent: DataFrame) -> DataFrame:
    """Foreign keys without a parent row, each with the number of rows that use it.

    A key with a NULL part refers to nothing and passes. Keys of both sides meet in one
    aggregation, each side counted on the map side first, so neither a much-used parent nor a
    repeated one is a large group.
    """
    mine, theirs = list(link.columns), list(link.parent_columns)
    if link.where:
        parent = parent.where(link.where)
    used = child.where(_all_present(mine)).select(*mine)
    known = parent.where(_all_present(theirs)).select(*[F.col(p).alias(c) for c, p in zip(mine, theirs, strict=True)])
    types = {f.name: f.dataType for f in used.schema}
    met = used.withColumn("_uses", F.lit(1).cast("bigint")).unionAll(known.withColumn("_uses", F.lit(0).cast("bigint")))
    counted = met.groupBy(*mine).agg(F.sum("_uses").alias("n_rows"), F.count_if(F.col("_uses") == 0).alias("_owners"))
    orphaned = counted.where("_owners = 0")
    return orphaned.select(*[F.col(c).cast(types[c]).alias(c) for c in mine], "n_rows")


def row_violations(df: DataFrame, rules: TableRules) -> DataFrame | None:
    """NOT NULL and CHECK rules of one table in one scan, as report rows."""
    tests = _row_rules(rules)
    if not tests:
        return None
    failed = F.array_compact(
        F.array(
            *[
                F.when(test, F.struct(F.lit(name).alias("constraint_name"), F.lit(kind).alias("kind")))
                for name, kind, test in tests
            ]
        )
    )
    return (
        df.where(broken_rows(rules))
        .select(key_text(rules.primary_key).alias("key"), F.inline(failed))
        .groupBy("constraint_name", "kind", "key")
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(rules.name).alias("table_name"), "constraint_name", "kind", "key", "n_rows")
    )


@dataclass
class _Key:
    """A key of a table that rows own and others may refer to."""

    table: str
    columns: tuple[str, ...]
    where: str | None = None
    types: list[T.DataType] = field(default_factory=list)
    primary: bool = False
    unique: bool = False
    references: list[tuple[str, ForeignKey]] = field(default_factory=list)


def _keys(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> list[_Key]:
    """All keys that the rules name, each once."""
    found: dict[tuple, _Key] = {}

    def key(table: str, columns: Sequence[str], where: str | None = None) -> _Key:
        columns = tuple(columns)
        if (table, columns, where) not in found:
            types = [tables[table].schema[c].dataType for c in columns]
            found[table, columns, where] = _Key(table, columns, where, types)
        return found[table, columns, where]

    for name, rule in rules.items():
        key(name, rule.primary_key).primary = True
        for columns in rule.unique:
            key(name, columns).unique = True
        for link in rule.foreign_keys:
            owner = key(link.parent, link.parent_columns, link.where)
            owner.references.append((name, link))
            typed = tables[link.parent].select(*[F.lit(None).cast(t) for t in owner.types])
            owner.types = _common_types(typed, tables[name].select(*link.columns))
    return list(found.values())


def _row_rules(rules: TableRules) -> list[tuple[str, str, Column]]:
    """(constraint, kind, condition that breaks it) of the rules that a row keeps by itself."""
    tests = [(f"{c}_not_null", "not_null", F.col(c).isNull()) for c in rules.not_null]
    return tests + [(name, "check", breaks(p)) for name, p in rules.checks.items()]


def broken_rows(rules: TableRules) -> Column:
    """True for rows that break a NOT NULL or CHECK rule."""
    return reduce(lambda a, b: a | b, [test for _, _, test in _row_rules(rules)], F.lit(False))


def violation_report(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> DataFrame:
    """Everything in ``tables`` that breaks a rule, one row per constraint and key."""
    keys = _keys(tables, rules)
    tags = [(k, None) for k in keys] + [(name, t) for name, rule in rules.items() for t in _row_rules(rule)]
    # a tagged key: its tag, its parts as texts of a common type, and who speaks: the owner, or a reference
    sizes = [len(k.columns if test is None else rules[k].primary_key) for k, test in tags]
    names = [f"part{i}" for i in range(max(sizes, default=0))]
    parts: dict[str, list[Column]] = {name: [] for name in tables}

    def add(table: str, tag: int, columns: Sequence[str], types: Sequence[T.DataType | None], speaker: int, when: Column) -> None:
        values = [_part(F.col(c), t) for c, t in zip(columns, types, strict=True)]
        values += [F.lit(None).cast("string")] * (len(names) - len(values))
        tagged = F.struct(F.lit(tag).alias("tag"), *[v.alias(n) for v, n in zip(values, names, strict=True)], F.lit(speaker).alias("speaker"))
        parts[table].append(F.when(when, tagged))

    for tag, (k, test) in enumerate(tags):
        if test is not None:
            add(k, tag, rules[k].primary_key, [None] * len(rules[k].primary_key), 0, test[2])
            continue
        owns = F.lit(True) if k.primary else _all_present(k.columns)
        add(k.table, tag, k.columns, k.types, 0, owns & F.coalesce(F.expr(k.where), F.lit(False)) if k.where else owns)
        for speaker, (child, link) in enumerate(k.references, 1):
            add(child, tag, link.columns, k.types, speaker, _all_present(link.columns))
    spoken = [
        tables[name].select(F.inline(F.array(*columns))).where("tag IS NOT NULL") for name, columns in parts.items() if columns
    ]
    n_speakers = 1 + max((len(k.references) for k in keys), default=0)
    counts = [F.count_if(F.col("speaker") == s).alias(f"n{s}") for s in range(n_speakers)]
    met = reduce(DataFrame.unionAll, spoken).groupBy("tag", *names).agg(*counts)

    wrong: list[tuple[Column, Column]] = []

    def row(tag: int, table: str, constraint: str, kind: str, n: str, when: Column) -> None:
        found = F.struct(
            F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint_name"), F.lit(kind).alias("kind"), F.col(n).alias("n_rows")
        )
        wrong.append(((F.col("tag") == tag) & when, found))

    for tag, (k, test) in enumerate(tags):
        whole = _all_present(names[: sizes[tag]])
        if test is not None:
            row(tag, k, test[0], test[1], "n0", F.lit(True))
            continue
        if k.primary:
            row(tag, k.table, "primary_key", "primary_key", "n0", (F.col("n0") > 1) | (~whole & (F.col("n0") > 0)))
        if k.unique:
            row(tag, k.table, f"{'_'.join(k.columns)}_unique", "unique", "n0", whole & (F.col("n0") > 1))
        for speaker, (child, link) in enumerate(k.references, 1):
            row(tag, child, link.name, "foreign_key", f"n{speaker}", (F.col("n0") == 0) & (F.col(f"n{speaker}") > 0))
    # the texts of a key are only put together for keys that break a rule
    bad = met.where(reduce(lambda a, b: a | b, [when for when, _ in wrong]))
    has = [[tag for tag, size in enumerate(sizes) if size > i] for i in range(len(names))]
    key = F.concat_ws("|", *[F.when(F.col("tag").isin(has[i]), _written(F.col(n))) for i, n in enumerate(names)])
    report = bad.select(key.alias("key"), F.inline(F.array_compact(F.array(*[F.when(when, found) for when, found in wrong]))))
    return report.select(*REPORT_COLUMNS)
