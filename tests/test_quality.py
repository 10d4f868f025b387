from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import (
    ORDER_RULES,
    ColumnRule,
    ValidationError,
    failure_cases,
    failure_summary,
    greater_than,
    validate,
    watch,
)

T1 = datetime(2024, 1, 1)
SCHEMA = "order_id int, customer_id int, amount double, order_date timestamp"
NAN = float("nan")
BAD = [
    (1, 1, 5.0, T1),
    (11, 3, 0.0, T1),
    (12, 3, -1.0, T1),
    (None, 3, -1.0, T1),
    (13, None, 2.0, T1),
    (14, 3, NAN, T1),
    (15, 3, None, T1),
]


def test_every_violation_is_reported(spark):
    df = spark.createDataFrame(BAD, SCHEMA)
    found = sorted(
        (str(r["order_id"]), r["column"], r["check"], r["failure_case"])
        for r in failure_cases(df, ORDER_RULES, ["order_id"]).collect()
    )
    assert found == sorted(
        [
            ("11", "amount", "greater_than(0)", "0.0"),
            ("12", "amount", "greater_than(0)", "-1.0"),
            ("None", "order_id", "not_nullable", None),
            ("None", "amount", "greater_than(0)", "-1.0"),
            ("14", "amount", "not_nullable", "NaN"),
            ("15", "amount", "not_nullable", None),
        ]
    )


def test_summary_counts_the_same(spark):
    df = spark.createDataFrame(BAD, SCHEMA)
    found = {tuple(r) for r in failure_summary(df, ORDER_RULES).collect()}
    assert found == {
        ("order_id", "not_nullable", 1),
        ("amount", "not_nullable", 2),
        ("amount", "greater_than(0)", 3),
    }


def test_gate(spark):
    good = spark.createDataFrame([(1, None, Decimal("1.00"), T1)], SCHEMA.replace("double", "decimal(10,2)"))
    assert validate(good, ORDER_RULES) is good
    assert validate(good.filter("false"), ORDER_RULES).count() == 0
    with pytest.raises(ValidationError) as error:
        validate(spark.createDataFrame(BAD, SCHEMA), ORDER_RULES)
    assert {(v.column, v.failures) for v in error.value.violations} == {
        ("order_id", 1), ("amount", 2), ("amount", 3),
    }
    assert "amount: greater_than(0) failed 3 times" in str(error.value)


def test_schema_rules_run_no_job(spark):
    df = spark.createDataFrame([("a", 1)], "order_id string, amount int")
    found = {(r["column"], r["check"], r["failure_case"]) for r in failure_cases(df, ORDER_RULES).collect()}
    assert found == {
        ("order_id", "dtype('int')", "string"),
        ("amount", "dtype('float')", "int"),
        ("customer_id", "column_in_dataframe", "customer_id"),
    }
    with pytest.raises(ValidationError):
        watch(df, ORDER_RULES)


def test_value_rule_still_runs_on_a_number_of_the_wrong_type(spark):
    df = spark.createDataFrame([(-1,), (1,)], "amount int")
    rules = [ColumnRule("amount", "float", checks=(greater_than(0),))]
    assert {tuple(r) for r in failure_summary(df, rules).collect()} == {
        ("amount", "dtype('float')", 1),
        ("amount", "greater_than(0)", 1),
    }


def test_no_rules(spark):
    df = spark.range(3)
    assert failure_cases(df, []).count() == 0
    assert failure_summary(df, []).count() == 0
    assert validate(df, [ColumnRule("id", "int", nullable=True)]).count() == 3


def test_watch_counts_during_the_write(spark, folder):
    observed, counts = watch(spark.createDataFrame(BAD, SCHEMA), ORDER_RULES)
    observed.write.parquet(folder + "/out")
    assert counts.rows == len(BAD)
    assert {(v.column, v.check, v.failures) for v in counts.violations()} == {
        ("order_id", "not_nullable", 1),
        ("amount", "not_nullable", 2),
        ("amount", "greater_than(0)", 3),
    }
    with pytest.raises(ValidationError):
        counts.raise_if_broken()


def test_bad_rows_are_picked_beside_the_scan(spark, folder, plan_of):
    spark.range(100).select("id", (F.col("id") - 3).alias("v")).write.parquet(folder + "/in")
    rules = [ColumnRule("v", "int", nullable=True, checks=(greater_than(0),))]
    cases = failure_cases(spark.read.parquet(folder + "/in"), rules, ["id"])
    plan = plan_of(cases)
    assert "LessThanOrEqual(v,0)" in plan and "Exchange" not in plan and "Python" not in plan
    assert cases.count() == 4


def test_watch_of_a_frame_known_to_be_empty(spark, folder):
    for i, df in enumerate([spark.range(5).filter("false"), spark.range(0), spark.range(5).limit(0)]):
        observed, counts = watch(df, [ColumnRule("id", "int")])
        observed.write.parquet(f"{folder}/out{i}")
        assert counts.rows == 0 and counts.violations() == []
