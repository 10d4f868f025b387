"""Every value that does not fit, without an error that stops the job."""

import pytest
from pyspark.sql import types as T

from millrace.operators import cast_cases, cast_summary, fitting, try_target

TARGET = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("amount", T.DecimalType(10, 2)),
        T.StructField("day", T.DateType()),
    ]
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_cases_of_texts(spark):
    df = spark.createDataFrame(
        [("1", "2.50", "2024-01-31", "a"), ("x", "n/a", "2024-02-30", "b"), (None, None, None, "c"), ("3000000000", "1", "", "d")],
        "id string, amount string, day string, line string",
    )
    tried = try_target(df, TARGET, keep=["line"])
    assert tried.schema["id"].dataType == T.IntegerType()
    assert rows(cast_cases(tried, ["line"])) == [
        ("b", "amount", "does_not_fit", "decimal(10,2)", "n/a"),
        ("b", "day", "does_not_fit", "date", "2024-02-30"),
        ("b", "id", "does_not_fit", "int", "x"),
        ("c", "id", "missing", "int", None),
        ("d", "day", "does_not_fit", "date", ""),
        ("d", "id", "does_not_fit", "int", "3000000000"),
    ]
    good = fitting(tried)
    assert [r["line"] for r in good.collect()] == ["a"] and good.columns == ["id", "amount", "day", "line"]
    assert rows(cast_summary(tried)) == [
        ("amount", "does_not_fit", 1), ("day", "does_not_fit", 2), ("id", "does_not_fit", 2), ("id", "missing", 1),
    ]


def test_numbers_that_a_cast_changes(spark):
    df = spark.sql("SELECT 1.0D AS id, 2.505D AS amount, date'2024-01-01' AS day UNION ALL SELECT 1.5D, 2.5D, null UNION ALL SELECT double('NaN'), 1e12D, null")
    assert rows(cast_cases(try_target(df, TARGET))) == [
        ("amount", "does_not_fit", "decimal(10,2)", "1.0E12"), ("id", "does_not_fit", "int", "NaN"),
    ]
    assert rows(cast_cases(try_target(df, TARGET, exact=True))) == [
        ("amount", "changed", "decimal(10,2)", "2.505"), ("amount", "does_not_fit", "decimal(10,2)", "1.0E12"),
        ("id", "changed", "int", "1.5"), ("id", "does_not_fit", "int", "NaN"),
    ]


def test_one_pass_without_a_shuffle(spark, plan_of):
    df = spark.createDataFrame([("1", "2", "3")], "id string, amount string, day string")
    plan = plan_of(cast_cases(try_target(df, TARGET)))
    assert "Exchange" not in plan and "Python" not in plan and plan.count("Scan") == 1


def test_columns_that_lack_or_clash(spark):
    df = spark.createDataFrame([("1", "2")], "id string, amount string")
    with pytest.raises(ValueError, match="lacks"):
        try_target(df, TARGET)
    with pytest.raises(ValueError, match="already"):
        try_target(df.selectExpr("*", "'x' as day"), TARGET, keep=["id"])
    assert cast_cases(try_target(df.selectExpr("*", "'x' as day").limit(0), TARGET)).collect() == []
