"""Data-quality assertions: each returns the failing rows; the suite returns one row per test."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted sums of exposure weights, as fractions or percents.
FRACTION_RANGE = (0.99, 1.01)
PERCENT_RANGE = (99, 101)


def _always(condition: str | None) -> Column:
    return F.expr(condition) if condition else F.lit(True)


# Row tests are predicates, so a suite can count many of them in one scan.


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: list) -> Column:
    return F.coalesce(~F.col(column).isin(values), F.lit(False))


def out_of_range(
    column: str, minimum=None, maximum=None, strictly: bool = False, row_condition: str | None = None
) -> Column:
    c = F.col(column)
    low = F.lit(False) if minimum is None else (c <= minimum if strictly else c < minimum)
    high = F.lit(False) if maximum is None else (c >= maximum if strictly else c > maximum)
    return F.coalesce(_always(row_condition) & (low | high), F.lit(False))


def violates(expression: str, row_condition: str | None = None) -> Column:
    return F.coalesce(_always(row_condition) & ~F.expr(expression), F.lit(False))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_null(column))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter("row_count > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(not_accepted(column, values))


def relationships(child: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """Child rows whose value is absent from the parent."""
    keys = parent.select(F.col(field_name).alias("_parent")).distinct()
    present = child.filter(F.col(column).isNotNull())
    return present.join(keys, F.col(column) == F.col("_parent"), "left_anti")


def compound_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations on more than one row; equal NULLs count as the same key."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def values_between(df: DataFrame, column: str, **bounds) -> DataFrame:
    return df.filter(out_of_range(column, **bounds))


def rows_satisfy(df: DataFrame, expression: str, row_condition: str | None = None) -> DataFrame:
    return df.filter(violates(expression, row_condition))


def weights_balance(df: DataFrame, group: str, weight: str) -> DataFrame:
    total = F.col("total_weight")
    return (
        df.filter(F.col(weight).isNotNull())
        .groupBy(F.col(group).alias("grouping_key"))
        .agg(F.sum(weight).alias("total_weight"))
        .filter(~(total.between(*FRACTION_RANGE) | total.between(*PERCENT_RANGE)))
    )


def max_is_recent(df: DataFrame, column: str, max_age_days: int, as_of: dt.date | Column) -> DataFrame:
    """The newest value when it is older than allowed; nothing for an empty table."""
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.agg(F.max(column).alias("max_value")).filter(
        F.col("max_value") < F.date_sub(today, max_age_days)
    )


# --- suite ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One declared test of a model."""

    model: str
    kind: str
    target: str
    severity: str = "error"
    options: Mapping = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.target}"


ROW_TESTS: dict[str, Callable[[Check], Column]] = {
    "not_null": lambda c: is_null(c.target),
    "accepted_values": lambda c: not_accepted(c.target, c.options["values"]),
    "between": lambda c: out_of_range(c.target, **c.options),
    "row_expression": lambda c: violates(c.options["expression"], c.options.get("row_condition")),
}


def _grouped_failures(check: Check, df: DataFrame, tables: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    if check.kind == "unique":
        return unique(df, check.target)
    if check.kind == "compound_unique":
        return compound_unique(df, check.options["columns"])
    if check.kind == "relationships":
        return relationships(df, check.target, tables[check.options["to"]], check.options["field"])
    if check.kind == "weights_balance":
        return weights_balance(df, check.options["group"], check.target)
    if check.kind == "recent":
        return max_is_recent(df, check.target, check.options["max_age_days"], as_of)
    raise ValueError(f"unknown test kind: {check.kind}")


def run_suite(checks: list[Check], tables: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """One row per test: name, model, severity, failing rows and status.

    All row tests of a model are counted in a single aggregate, so a model is scanned once for
    them; each grouped test adds its own aggregate. Nothing but counts leaves the executors.
    """
    frames = []
    by_model: dict[str, list[Check]] = {}
    for check in checks:
        by_model.setdefault(check.model, []).append(check)
    for model, declared in by_model.items():
        df = tables[model]
        row_checks = [c for c in declared if c.kind in ROW_TESTS]
        if row_checks:
            counts = [F.count_if(ROW_TESTS[c.kind](c)).alias(f"n{i}") for i, c in enumerate(row_checks)]
            pairs = [
                F.struct(_label(c, "test"), _label(c, "model"), _label(c, "severity"), F.col(f"n{i}").alias("n_failures"))
                for i, c in enumerate(row_checks)
            ]
            frames.append(df.agg(*counts).select(F.inline(F.array(*pairs))))
        for c in declared:
            if c.kind in ROW_TESTS:
                continue
            failing = _grouped_failures(c, df, tables, as_of)
            frames.append(
                failing.agg(F.count(F.lit(1)).alias("n_failures")).select(
                    _label(c, "test"), _label(c, "model"), _label(c, "severity"), "n_failures"
                )
            )
    result = reduce(DataFrame.unionByName, frames)
    failed = F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    return result.withColumn("status", F.when(F.col("n_failures") == 0, "pass").otherwise(failed))


def _label(check: Check, part: str) -> Column:
    return F.lit({"test": check.name, "model": check.model, "severity": check.severity}[part]).alias(part)
