"""Batches of changes: inserts with defaults, stock updates, all-or-nothing application.

A batch is judged on what it touches. Existing tables are met only by the distinct keys
of the batch, with the existing side as the one that is kept, so that a small batch is
broadcast and the large table is scanned for its key columns without a shuffle. What a row
of the batch breaks by itself is counted while the batch is written; it is read again for
that only if there is something to report.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.operators import quality
from storefront.schemas import TableRules
from storefront.session import land_observed, remove_scratch, spread
from storefront.sources.tables import run_sql


def with_defaults(batch: DataFrame, like: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Bring a batch to the columns and types of a table.

    A column the batch leaves out gets its default, or NULL without one. A NULL that
    the batch states itself stays.
    """
    unknown = set(batch.columns) - set(like.columns)
    if unknown:
        raise ValueError(f"columns not in the table: {sorted(unknown)}")
    columns = []
    for f in like.schema.fields:
        source = F.col(f.name) if f.name in batch.columns else F.expr(defaults.get(f.name, "NULL"))
        columns.append(source.cast(f.dataType).alias(f.name))
    return batch.select(*columns)


def dated(batch: DataFrame, column: str, day: date | None = None) -> DataFrame:
    """The batch with the day it comes in: ``day``, bound as a parameter, else the current date."""
    text = f"SELECT *, coalesce(CAST(:day AS DATE), current_date()) AS `{column}` FROM {{batch}}"
    return run_sql(batch.sparkSession, text, {"batch": batch.drop(column)}, {"day": day})


def append_rows(existing: DataFrame, batch: DataFrame, defaults: Mapping[str, str] | None = None) -> DataFrame:
    """The table with the rows of the batch added, defaults filled in."""
    return existing.unionByName(with_defaults(batch, existing, defaults or {}))


def _free(name: str, *tables: DataFrame) -> str:
    """A column name like ``name`` that none of the tables has."""
    taken = {c.lower() for df in tables for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def subtract_stock(
    products: DataFrame, changes: DataFrame, key: str = "product_id",
    stock: str = "stock_qty", quantity: str = "quantity",
) -> DataFrame:
    """Take the quantities of ``changes`` off the stock of their products.

    Several changes of one product add up; a change of an unknown product does nothing. A
    change without a quantity says nothing that could be done, and stops the job.
    """
    dtype = products.schema[stock].dataType
    taken = _free("taken", products, changes)
    refused = F.raise_error(F.lit(f"a stock change without {quantity}")).cast(changes.schema[quantity].dataType)
    stated = F.when(F.col(quantity).isNull(), refused).otherwise(F.col(quantity))
    summed = changes.groupBy(key).agg(F.sum(stated).alias(taken))
    left = F.col(stock) - F.coalesce(F.col(taken), F.lit(0))
    return products.join(summed, key, "left").withColumn(stock, left.cast(dtype)).select(*products.columns)


@dataclass(frozen=True)
class StockUpdate:
    """Quantities to take off a table's stock column, as rows (key, quantity)."""

    table: str
    changes: DataFrame
    key: str = "product_id"
    stock: str = "stock_qty"
    quantity: str = "quantity"


@dataclass(frozen=True)
class BatchResult:
    """``verdict`` is one row (accepted, n_violations), ``violations`` says what is wrong,
    ``tables`` is the next state. ``scratch`` are the folders that they are read from."""

    verdict: DataFrame
    violations: DataFrame
    tables: dict[str, DataFrame]
    scratch: tuple[str, ...] = ()

    def remove_scratch(self) -> None:
        """Delete what was landed, once the next state is written elsewhere."""
        for path in self.scratch:
            remove_scratch(self.verdict.sparkSession, path)


def _meeting(existing: DataFrame, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``existing`` that have one of the ``keys``, as their key columns."""
    return existing.select(*columns).join(spread(keys.select(*columns), *columns), list(columns), "left_semi")


def _key_report(
    existing: DataFrame, batch: DataFrame, table: str, columns: Sequence[str], primary: bool
) -> DataFrame:
    """Keys of the batch that repeat within it or exist already (or are NULL, if primary)."""
    columns = list(columns)
    used = quality.key_counts(batch, columns)
    known = _free("taken", used)
    # both meet in one aggregation: joined, they would share a task with all that makes them
    own = [F.col(f.name).cast(f.dataType).alias(f.name) for f in used.schema if f.name in columns]
    taken = _meeting(existing, used, columns).select(*own, F.lit(0).cast("bigint").alias("n_rows"), F.lit(True).alias(known))
    told = used.withColumn(known, F.lit(False)).unionByName(taken)
    told = told.groupBy(*columns).agg(F.sum("n_rows").alias("n_rows"), F.max(known).alias(known))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    clash = whole & ((F.col("n_rows") > 1) | F.col(known))
    bad = clash | ~whole if primary else clash
    kind = "primary_key" if primary else "unique"
    return (
        told.where(bad)
        .select(
            F.lit(table).alias("table_name"),
            F.lit(kind if primary else f"{'_'.join(columns)}_unique").alias("constraint_name"),
            F.lit(kind).alias("kind"),
            quality.key_text(columns).alias("key"),
            "n_rows",
        )
    )


def _missing_quantity(stock: StockUpdate) -> DataFrame:
    """Changes without a quantity, as report rows."""
    return (
        stock.changes.where(F.col(stock.quantity).isNull())
        .groupBy(stock.key)
        .agg(F.count("*").alias("n_rows"))
        .select(
            F.lit(stock.table).alias("table_name"), F.lit(f"{stock.quantity}_not_null").alias("constraint_name"),
            F.lit("not_null").alias("kind"), quality.key_text([stock.key]).alias("key"), "n_rows",
        )
    )


def batch_violations(
    existing: Mapping[str, DataFrame],
    batch: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules],
    stock: StockUpdate | None = None,
    sound: Collection[str] = (),
) -> DataFrame:
    """What would be wrong after the batch, as rows of a violation report.

    ``sound`` names tables of the batch whose rows are known to keep the rules that a row keeps
    by itself (and ``""`` for stock changes that are known to have quantities).
    """
    parts: list[DataFrame] = []
    for name, rows in batch.items():
        rule = rules[name]
        row_level = None if name in sound else quality.row_violations(rows, rule)
        if row_level is not None:
            parts.append(row_level)
        parts.append(_key_report(existing[name], rows, name, rule.primary_key, primary=True))
        for columns in rule.unique:
            parts.append(_key_report(existing[name], rows, name, columns, primary=False))
        for link in rule.foreign_keys:
            mine, theirs = list(link.columns), list(link.parent_columns)
            parents = existing[link.parent]
            if link.parent in batch:
                parents = parents.unionByName(batch[link.parent])
            parents = (parents.where(link.where) if link.where else parents).select(*theirs)
            present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in mine])
            used = quality.key_counts(rows.where(present), mine)
            found = _meeting(parents.toDF(*mine), used, mine).distinct()
            parts.append(
                used.join(found, mine, "left_anti").select(
                    F.lit(name).alias("table_name"),
                    F.lit(link.name).alias("constraint_name"),
                    F.lit("foreign_key").alias("kind"),
                    quality.key_text(mine).alias("key"),
                    "n_rows",
                )
            )
    if stock is not None:
        if "" not in sound:
            parts.append(_missing_quantity(stock))
        products = existing[stock.table]
        if stock.table in batch:
            products = products.unionByName(batch[stock.table])
        stated = stock.changes.where(F.col(stock.quantity).isNotNull())
        touched = products.join(stated.select(stock.key).distinct(), stock.key, "left_semi")
        after = subtract_stock(touched, stated, stock.key, stock.stock, stock.quantity)
        row_level = quality.row_violations(after, rules[stock.table])
        if row_level is not None:
            parts.append(row_level)
    return reduce(DataFrame.unionByName, parts)


def apply_batch(
    existing: Mapping[str, DataFrame],
    batch: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules],
    stock: StockUpdate | None = None,
    durable: bool = True,
) -> BatchResult:
    """The next state of all tables: the whole batch applied, or nothing of it.

    ``durable`` writes the batch and what is wrong with it to the shared folder once, so that
    tables written one after the other cannot see different rows or verdicts, and neither the
    batch nor its checks are computed again. These writes count on the way: the rows that break
    a rule by themselves, the changes without a quantity, and in the end the violations, so no
    table is read again for the verdict. Without it everything stays one plan, and the verdict
    is a row that every table of the next state reads as a scalar subquery.
    """
    complete = {n: with_defaults(rows, existing[n], rules[n].defaults) for n, rows in batch.items()}
    if durable:
        return _apply_landed(existing, complete, rules, stock)
    violations = batch_violations(existing, complete, rules, stock)
    verdict = violations.agg(
        (F.count("*") == 0).alias("accepted"), F.count("*").alias("n_violations")
    )
    accepted = verdict.select("accepted").scalar()
    return BatchResult(verdict, violations, _next_state(existing, complete, stock, accepted))


def _next_state(
    existing: Mapping[str, DataFrame], batch: Mapping[str, DataFrame], stock: StockUpdate | None, accepted: Column
) -> dict[str, DataFrame]:
    tables = dict(existing)
    for name, rows in batch.items():
        tables[name] = existing[name].unionByName(rows.where(accepted))
    if stock is not None:
        tables[stock.table] = subtract_stock(
            tables[stock.table], stock.changes.where(accepted), stock.key, stock.stock, stock.quantity
        )
    return tables


def _apply_landed(
    existing: Mapping[str, DataFrame], batch: Mapping[str, DataFrame], rules: Mapping[str, TableRules], stock: StockUpdate | None
) -> BatchResult:
    """``apply_batch`` with the batch landed and counted as it is written."""
    landed, sound, scratch = {}, set(), []
    for name, rows in batch.items():
        landed[name], seen, path = land_observed(rows, f"batch-{name}", broken=F.count_if(quality.broken_rows(rules[name])))
        scratch.append(path)
        if not seen["broken"]:
            sound.add(name)
    if stock is not None:
        absent = F.count_if(F.col(stock.quantity).isNull())
        moved, seen, path = land_observed(stock.changes, "batch-stock", absent=absent)
        scratch.append(path)
        stock = replace(stock, changes=moved)
        if not seen["absent"]:
            sound.add("")
    found = batch_violations(existing, landed, rules, stock, sound)
    violations, seen, path = land_observed(found, "batch-violations", n=F.count("*"))
    scratch.append(path)
    spark = violations.sparkSession
    accepted = seen["n"] == 0
    verdict = spark.range(1).select(F.lit(accepted).alias("accepted"), F.lit(seen["n"]).cast("bigint").alias("n_violations"))
    # a batch that is refused leaves the tables as they are, without another plan over them
    tables = _next_state(existing, landed, stock, F.lit(True)) if accepted else dict(existing)
    return BatchResult(verdict, violations, tables, tuple(scratch))
