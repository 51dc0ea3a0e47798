"""Data-quality gates. Every row rule of a table is a counter in one shared pass; each
foreign key adds one anti-join over distinct keys. The report is a small table, and
:func:`enforce` turns it into an error."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstar.functions.calendar import WINDOW_END, WINDOW_START

REPORT = "table_name string, check_name string, column_name string, n_bad long, sample string"

# How many offending values an error shows.
SHOWN = 10


class QualityError(ValueError):
    """Raised by :func:`enforce`; the message names each failed check."""


@dataclass(frozen=True)
class RowRule:
    """Rows for which ``bad`` is true break the rule; NULL counts as kept."""

    check: str
    column: str
    bad: Column


@dataclass(frozen=True)
class CountRule:
    """The number of rows for which ``counted`` is true must be exactly ``expected``."""

    check: str
    column: str
    counted: Column
    expected: int


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: DataFrame
    parent_key: str


def no_nulls(*columns: str) -> list[RowRule]:
    return [RowRule("no_nulls", c, F.col(c).isNull()) for c in columns]


def date_bounds(column: str, day: Column | None = None, first: date = WINDOW_START,
                last: date = WINDOW_END) -> RowRule:
    """Closed date bounds; ``day`` says how to read the column if it is not a date."""
    value = F.col(column) if day is None else day
    return RowRule("date_bounds", column, ~value.between(F.lit(first), F.lit(last)))


def valid_ids(column: str, allowed: list) -> RowRule:
    return RowRule("valid_ids", column, ~F.col(column).isin(*allowed))


def within(column: str, low: float, high: float) -> RowRule:
    return RowRule("within", column, ~F.col(column).between(low, high))


def at_least(column: str, low: int) -> RowRule:
    return RowRule("at_least", column, F.col(column) < low)


def not_above(column: str, limit: str) -> RowRule:
    return RowRule("not_above", column, F.col(column) > F.col(limit))


def row_count(expected: int) -> CountRule:
    return CountRule("row_count", "*", F.lit(True), expected)


def regional_row_count(expected: int, column: str = "region_id") -> CountRule:
    return CountRule("regional_row_count", column, F.col(column).isNotNull(), expected)


def _finding(table: str, check: str, column: str, n_bad: Column, sample: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        n_bad.cast("bigint").alias("n_bad"),
        sample.cast("string").alias("sample"),
    )


def _rule_columns(table: str, rules: list[RowRule | CountRule]) -> tuple[list[Column], list[Column]]:
    """The counters of all rules, and the findings that are made from them."""
    metrics, findings = [], []
    for i, rule in enumerate(rules):
        bad, worst = F.col(f"n{i}"), F.col(f"s{i}")
        if isinstance(rule, CountRule):
            metrics += [
                F.count_if(rule.counted).alias(f"n{i}"),
                F.lit(None).cast("string").alias(f"s{i}"),
            ]
            findings.append(
                _finding(table, rule.check, rule.column, F.abs(bad - rule.expected),
                         F.when(bad != rule.expected, bad))
            )
        else:
            metrics += [
                F.count_if(rule.bad).alias(f"n{i}"),
                F.min(F.when(rule.bad, F.col(rule.column))).cast("string").alias(f"s{i}"),
            ]
            findings.append(_finding(table, rule.check, rule.column, bad, worst))
    return metrics, findings


def row_report(df: DataFrame, table: str, rules: list[RowRule | CountRule]) -> DataFrame:
    """All row and count rules of a table in one aggregate. The sample is the smallest
    offending value; a count rule reports how far off the count is, and the count."""
    metrics, findings = _rule_columns(table, rules)
    return df.agg(*metrics).select(F.inline(F.array(*findings)))


def rule_metrics(rules: list[RowRule | CountRule]) -> list[Column]:
    """The counters of the rules, to be observed while rows are written."""
    return _rule_columns("", rules)[0] if rules else []


def observed_report(
    spark: SparkSession, table: str, rules: list[RowRule | CountRule], seen: dict
) -> DataFrame:
    """The same report as :func:`row_report` from observed counters, without reading a row."""
    findings = []
    for i, rule in enumerate(rules):
        bad, worst = seen.get(f"n{i}") or 0, seen.get(f"s{i}")
        if isinstance(rule, CountRule):
            worst = str(bad) if bad != rule.expected else None
            bad = abs(bad - rule.expected)
        findings.append((table, rule.check, rule.column, bad, worst))
    return spark.createDataFrame(findings, REPORT)


def orphans(df: DataFrame, key: ForeignKey) -> DataFrame:
    """Distinct non-null values of a foreign key that have no parent."""
    values = df.where(F.col(key.column).isNotNull()).select(F.col(key.column).alias("value"))
    parents = key.parent.select(F.col(key.parent_key).alias("value"))
    return values.distinct().join(parents, "value", "left_anti")


def first_offenders(offenders: DataFrame, shown: int = SHOWN) -> DataFrame:
    return offenders.orderBy("value").limit(shown)


def key_report(df: DataFrame, table: str, keys: list[ForeignKey]) -> DataFrame:
    """All foreign keys of a table in one pass: the distinct values of every key, as text,
    against the values of their parents. The sample is the smallest offender."""
    def listed(values: list[Column]) -> Column:
        return F.inline(F.array(*[
            F.struct(F.lit(i).alias("key"), v.cast("string").alias("value"))
            for i, v in enumerate(values)
        ]))

    used = df.select(listed([F.col(k.column) for k in keys])).where("value IS NOT NULL").distinct()
    parents = reduce(DataFrame.unionByName, [
        k.parent.select(F.lit(i).alias("key"), F.col(k.parent_key).cast("string").alias("value"))
        for i, k in enumerate(keys)
    ])
    lost = used.join(parents, ["key", "value"], "left_anti")
    size = F.struct(F.col("value").try_cast("double").alias("number"), "value")
    counted = lost.agg(*[
        column
        for i in range(len(keys))
        for column in (
            F.count_if(F.col("key") == i).alias(f"n{i}"),
            F.min(F.when(F.col("key") == i, size)).alias(f"s{i}"),
        )
    ])
    return counted.select(F.inline(F.array(*[
        _finding(table, "foreign_key", k.column, F.col(f"n{i}"), F.col(f"s{i}.value"))
        for i, k in enumerate(keys)
    ])))


def unique_report(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    repeated = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    label = ", ".join(columns)
    return repeated.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.concat_ws(", ", *[F.col(c).cast("string") for c in columns])).alias("low"),
    ).select(F.inline(F.array(_finding(table, "unique", label, F.col("n"), F.col("low")))))


def report(
    df: DataFrame,
    table: str,
    rules: list[RowRule | CountRule] | None = None,
    foreign_keys: list[ForeignKey] | None = None,
    unique: list[str] | None = None,
) -> DataFrame:
    """``table_name, check_name, column_name, n_bad, sample``, one row per check."""
    parts = []
    if rules:
        parts.append(row_report(df, table, rules))
    if foreign_keys:
        parts.append(key_report(df, table, foreign_keys))
    if unique:
        parts.append(unique_report(df, table, unique))
    return reduce(DataFrame.unionByName, parts)


def enforce(checked: DataFrame) -> None:
    """Raise if any check of a report failed. The report has one row per check, so
    reading it on the driver is safe."""
    failed = checked.where(F.col("n_bad") > 0).collect()
    if failed:
        raise QualityError(
            "; ".join(
                f"{r.table_name}.{r.column_name}: {r.check_name} fails {r.n_bad} time(s),"
                f" e.g. {r.sample}"
                for r in failed
            )
        )


def missing_authored(df: DataFrame, column: str, name: str) -> DataFrame:
    """Names whose authored field is still empty."""
    return df.where(F.col(column).isNull()).select(name)


def at_cap(counts: DataFrame, count: str, cap: int) -> DataFrame:
    """Groups that hold as many rows as a source returns at most: their counts are
    lower bounds."""
    return counts.where(F.col(count) >= cap)
