"""Sums whose bits do not depend on the order of the rows."""

import math
import random
import struct

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.operators import exact_sums
from millrace.sources import read_parquet

SF_DIR = "/root/testdata/sf0.001"
bits = lambda x: None if x is None else struct.pack(">d", x)


def sums(spark, groups, parts=1):
    rows = [(k, v) for k, values in enumerate(groups) for v in values]
    df = spark.createDataFrame(rows, "k int, v double").repartition(parts)
    found = exact_sums(df, ["k"], {"total": "v"}, {"mean": "v"}).collect()
    return {r["k"]: (r["total"], r["mean"]) for r in found}


finite = st.floats(allow_nan=False, allow_infinity=False)
wide = st.one_of(
    finite,
    st.floats(-1e6, 1e6),
    st.builds(math.ldexp, st.sampled_from([1.0, -1.0, 1.5, -1.0 - 2**-52]), st.integers(-1074, 1020)),
    st.sampled_from([5e-324, -5e-324, 2.0**1023, -(2.0**1023), 1e16, 1.0, -1e16, 0.0, -0.0, 2.0**53, 2.0**53 + 2]),
)


def exact(values):
    """The correctly rounded sum, beyond the doubles infinite."""
    try:
        return math.fsum(values)
    except OverflowError:
        from fractions import Fraction

        total = sum(map(Fraction, values))
        if abs(total) >= Fraction(2) ** 1024 - Fraction(2) ** 970:
            return math.inf if total > 0 else -math.inf
        return float(total)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(wide, min_size=1, max_size=12), min_size=1, max_size=60))
def test_sums_are_the_nearest_doubles(spark, groups):
    found = sums(spark, groups, 3)
    for k, values in enumerate(groups):
        expected = exact(values)
        assert bits(found[k][0] + 0.0) == bits(expected + 0.0), values
        assert found[k][1] == pytest.approx(found[k][0] / len(values), nan_ok=True)


def test_sums_that_cancel_and_that_lie_between_two_doubles(spark):
    groups = [
        [1e308, 1.0, -1e308],
        [2.0**53, 1.0],
        [2.0**53, 1.0, 2.0**-200],
        [2.0**53 + 2, 1.0],
        [2.0**53 + 2, 1.0, -(2.0**-200)],
        [-(2.0**53), -1.0, -(2.0**-1074)],
        [1.0] * 5 + [-5.0],
        [0.1] * 10,
        [5e-324] * 3,
        [2.0**1023, 2.0**1023],
        [-(2.0**1023)] * 2 + [2.0**1023],
        [2.0**-1022, -5e-324],
    ]
    found = sums(spark, groups)
    assert [bits(found[k][0]) for k in range(len(groups))] == [bits(exact(g)) for g in groups]


def test_the_bits_do_not_depend_on_the_partitioning(spark):
    rng = random.Random(5)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 12) for _ in range(20_000)]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "k int, v double")
    found = set()
    for n in (1, 3, 17):
        frame = df.repartition(n).orderBy(F.rand(n)) if n > 1 else df
        found.add(tuple(bits(r["s"]) for r in exact_sums(frame, ["k"], {"s": "v"}).orderBy("k").collect()))
    assert found == {tuple(bits(math.fsum(values[k::3])) for k in range(3))}


def test_special_values_and_nulls(spark):
    nan, inf = float("nan"), float("inf")
    groups = [[nan, 1.0], [inf, 1.0], [inf, -inf], [-inf], [None], [None, 2.0], [-0.0], [0.0, -0.0]]
    found = sums(spark, groups)
    assert math.isnan(found[0][0]) and found[1][0] == inf and math.isnan(found[2][0]) and found[3][0] == -inf
    assert found[4] == (None, None) and found[5] == (2.0, 2.0) and found[6][0] == 0.0 and found[7] == (0.0, 0.0)


def test_several_columns_null_keys_and_empty_frames(spark):
    df = spark.createDataFrame([(None, "x", 1.5, 2.0), (None, "x", 0.25, None), (1, None, 3.0, 4.0)], "a int, `b.c` string, v double, w double")
    found = exact_sums(df, ["a", "b.c"], {"v": "v", "w": "w"}, {"m": "v"}).orderBy("v").collect()
    assert [tuple(r) for r in found] == [(None, "x", 1.75, 2.0, 0.875), (1, None, 3.0, 4.0, 3.0)]
    assert exact_sums(df.limit(0), ["a"], {"v": "v"}).collect() == []
    with pytest.raises(ValueError):
        exact_sums(df, ["a"], {})


def test_whole_lineitem(spark):
    items = read_parquet(spark, f"{SF_DIR}/lineitem.parquet")
    found = exact_sums(items, ["l_suppkey"], {"s": "l_extendedprice"}).collect()
    by_key = {}
    for r in items.select("l_suppkey", "l_extendedprice").collect():
        by_key.setdefault(r[0], []).append(r[1])
    assert {r["l_suppkey"]: bits(r["s"]) for r in found} == {k: bits(math.fsum(v)) for k, v in by_key.items()}


def test_a_key_sends_few_rows(spark, plan_of):
    """Rows are combined before the first exchange: by key, column and bin."""
    plan = plan_of(exact_sums(spark.range(10).selectExpr("1 as k", "cast(id as double) as v"), ["k"], {"s": "v"}))
    assert plan.count("Exchange") <= 3 and "Python" not in plan
