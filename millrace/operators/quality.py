"""Column rules, checked on all rows in one scan, with every violation reported."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from millrace.functions import quoted

# The names the checks go by in a report.
REQUIRED = "column_in_dataframe"
NOT_NULL = "not_nullable"
DTYPE = "dtype('{}')"
GREATER_THAN = "greater_than({})"

FAILURE_CASES = "column string, check string, failure_case string"
FAILURE_SUMMARY = "column string, check string, failures bigint"

_TYPE_FAMILIES: dict[str, tuple[type[T.DataType], ...]] = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "string": (T.StringType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
}


@dataclass(frozen=True)
class Check:
    """A rule on a value. ``violates`` gives the condition under which the value breaks it.

    Nulls and NaN are the business of the null rule and never break a value rule.
    """

    name: str
    violates: Callable[[Column], Column]


def greater_than(bound: int | float) -> Check:
    # Spark orders NaN above every number, so NaN does not pass this condition.
    return Check(GREATER_THAN.format(bound), lambda c: c <= F.lit(bound))


@dataclass(frozen=True)
class ColumnRule:
    """What a column must be: its type (no coercion), whether it may be null, value checks."""

    column: str
    dtype: str | None = None
    nullable: bool = False
    checks: Sequence[Check] = ()


@dataclass(frozen=True)
class Violation:
    """A broken rule and how often it was broken."""

    column: str
    check: str
    failures: int


class ValidationError(ValueError):
    """The data breaks the rules. Carries one entry per broken rule, not the rows."""

    def __init__(self, violations: Sequence[Violation]):
        self.violations = list(violations)
        lines = [f"{v.column}: {v.check} failed {v.failures} times" for v in self.violations]
        super().__init__("; ".join(lines))


@dataclass(frozen=True)
class _RowRule:
    column: str
    check: str
    broken: Column


def _schema_failures(df: DataFrame, rules: Sequence[ColumnRule]) -> list[tuple[str, str, str]]:
    """Rules the schema alone can break: no job runs for these."""
    types = {f.name: f.dataType for f in df.schema.fields}
    failures = []
    for rule in rules:
        if rule.column not in types:
            failures.append((rule.column, REQUIRED, rule.column))
        elif rule.dtype is not None and not isinstance(
            types[rule.column], _TYPE_FAMILIES[rule.dtype]
        ):
            found = types[rule.column].simpleString()
            failures.append((rule.column, DTYPE.format(rule.dtype), found))
    return failures


def _row_rules(df: DataFrame, rules: Sequence[ColumnRule]) -> list[_RowRule]:
    types = {f.name: f.dataType for f in df.schema.fields}
    result = []
    for rule in rules:
        data_type = types.get(rule.column)
        if data_type is None:
            continue
        value = quoted(rule.column)
        floating = isinstance(data_type, (T.FloatType, T.DoubleType))
        if not rule.nullable:
            broken = value.isNull() | F.isnan(value) if floating else value.isNull()
            result.append(_RowRule(rule.column, NOT_NULL, broken))
        wrong_type = rule.dtype is not None and not isinstance(
            data_type, _TYPE_FAMILIES[rule.dtype]
        )
        # Comparing a column of the wrong type would stop the job instead of reporting.
        if not wrong_type or isinstance(data_type, T.NumericType):
            for check in rule.checks:
                result.append(_RowRule(rule.column, check.name, check.violates(value)))
    return result


def _any_broken(row_rules: Sequence[_RowRule]) -> Column:
    return functools.reduce(operator.or_, [r.broken for r in row_rules], F.lit(False))


def failure_cases(
    df: DataFrame, rules: Sequence[ColumnRule], id_columns: Sequence[str] = ()
) -> DataFrame:
    """One row per violation: the row's ids, column, check and the offending value as text.

    Sound rows are dropped by a filter beside the scan, so only bad ones are expanded, and
    nothing is shuffled. A broken schema rule gives one row without ids.
    """
    row_rules = _row_rules(df, rules)
    ids = [quoted(c) for c in id_columns]
    cases = df.filter(_any_broken(row_rules))
    if row_rules:
        entries = F.array(
            *[
                F.when(
                    r.broken,
                    F.struct(
                        F.lit(r.column).alias("column"),
                        F.lit(r.check).alias("check"),
                        quoted(r.column).cast("string").alias("failure_case"),
                    ),
                )
                for r in row_rules
            ]
        )
        cases = (
            cases.select(*ids, F.explode(entries).alias("__case"))
            .filter(F.col("__case").isNotNull())
            .select(*ids, "__case.column", "__case.check", "__case.failure_case")
        )
    else:
        empty = [F.lit("").alias(c) for c in ("column", "check", "failure_case")]
        cases = cases.select(*ids, *empty)

    schema_failures = _schema_failures(df, rules)
    if schema_failures:
        extra = df.sparkSession.createDataFrame(schema_failures, FAILURE_CASES)
        cases = cases.unionByName(extra, allowMissingColumns=True)
    return cases


def failure_summary(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """How often each rule is broken: one row per broken rule, counted in one scan."""
    row_rules = _row_rules(df, rules)
    schema_failures = [(c, k, 1) for c, k, _ in _schema_failures(df, rules)]
    parts = []
    if row_rules:
        counts = df.filter(_any_broken(row_rules)).agg(
            *[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(row_rules)]
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(r.column).alias("column"),
                    F.lit(r.check).alias("check"),
                    F.col(f"r{i}").alias("failures"),
                )
                for i, r in enumerate(row_rules)
            ]
        )
        parts.append(counts.select(F.inline(entries)).filter("failures > 0"))
    if schema_failures or not parts:
        parts.append(df.sparkSession.createDataFrame(schema_failures, FAILURE_SUMMARY))
    return functools.reduce(DataFrame.unionByName, parts)


def validate(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """Give the frame back unchanged if it keeps all rules, else raise ``ValidationError``.

    This scans the data once for the check. Where the frame is written anyway, ``watch``
    counts during the write and saves that scan.
    """
    broken = failure_summary(df, rules).collect()  # at most one row per rule
    if broken:
        raise ValidationError([Violation(r["column"], r["check"], r["failures"]) for r in broken])
    return df


@dataclass(frozen=True)
class Watch:
    """Rule and row counts of a frame, filled while an action on it runs."""

    observation: Observation
    rules: Sequence[tuple[str, str]]

    @property
    def rows(self) -> int:
        return self.observation.get["rows"]

    def violations(self) -> list[Violation]:
        counts = self.observation.get
        found = [Violation(c, k, counts[f"r{i}"]) for i, (c, k) in enumerate(self.rules)]
        return [v for v in found if v.failures]

    def raise_if_broken(self) -> None:
        violations = self.violations()
        if violations:
            raise ValidationError(violations)


def watch(df: DataFrame, rules: Sequence[ColumnRule] = ()) -> tuple[DataFrame, Watch]:
    """Count rows and broken rules as a by-product of the next action on the returned frame.

    Broken schema rules raise at once. Put it right before a write: counts taken in the
    last stage are exact even when a lost executor makes Spark run a task again. A shuffle for
    the write belongs below it: ``watch(sinks.by_size(df, ...))``.
    """
    schema_failures = _schema_failures(df, rules)
    if schema_failures:
        raise ValidationError([Violation(c, k, 1) for c, k, _ in schema_failures])
    row_rules = _row_rules(df, rules)
    observation = Observation()
    observed = df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(row_rules)],
    )
    return observed, Watch(observation, [(r.column, r.check) for r in row_rules])


# The rules an orders table must keep before it is landed.
ORDER_RULES = (
    ColumnRule("order_id", "int"),
    ColumnRule("amount", "float", checks=(greater_than(0),)),
    ColumnRule("customer_id", "int", nullable=True),
)
