"""Any associative and commutative function by key."""

import functools
import operator

import pytest
from pyspark.sql import functions as F

from millrace.operators import fold, fold_by_key

PRIME = 1_000_003


def product(a, b):
    return (a * b) % F.lit(PRIME)


def expected(rows, combine):
    found = {}
    for k, v in rows:
        found.setdefault(k, [])
        if v is not None:
            found[k].append(v)
    return {k: functools.reduce(combine, v) if v else None for k, v in found.items()}


@pytest.mark.parametrize("bits, rounds", [(0, 1), (1, 2), (3, 2), (12, 0), (12, 2)])
def test_products_by_key(spark, monkeypatch, bits, rounds):
    monkeypatch.setattr(fold, "_BATCH_BITS", bits)
    rows = [(None if i % 11 == 0 else i % 3, None if i % 13 == 0 else i % 97 + 2) for i in range(1500)] + [(9, None)]
    df = spark.createDataFrame(rows, "k int, v bigint").repartition(5)
    found = {r["k"]: r["value"] for r in fold_by_key(df, ["k"], "v", product, rounds=rounds).collect()}
    assert found == expected(rows, lambda a, b: a * b % PRIME)


def test_texts_and_structs(spark):
    rows = [("a", "xx"), ("a", "y"), ("b", ""), ("a", "zz"), (None, "n")]
    df = spark.createDataFrame(rows, "k string, t string").repartition(3)
    longer = lambda a, b: F.when((F.length(a) > F.length(b)) | ((F.length(a) == F.length(b)) & (a < b)), a).otherwise(b)
    found = {r["k"]: r["longest"] for r in fold_by_key(df, ["k"], "t", longer, "longest").collect()}
    assert found == {"a": "xx", "b": "", None: "n"}
    pairs = df.select("k", F.struct(F.length("t").alias("n"), F.lit(1).alias("one")).alias("p"))
    both = lambda a, b: F.struct((a["n"] + b["n"]).alias("n"), (a["one"] + b["one"]).alias("one"))
    found = {r["k"]: tuple(r["p"]) for r in fold_by_key(pairs, ["k"], "p", both, "p").collect()}
    assert found == {"a": (5, 3), "b": (0, 1), None: (1, 1)}


def test_bits_by_several_keys_with_odd_names(spark):
    rows = [(i % 2, i % 5, i) for i in range(400)]
    df = spark.createDataFrame(rows, "`a.b` int, `_v` int, c int")
    found = fold_by_key(df, ["a.b", "_v"], "c", lambda a, b: a.bitwiseXOR(b), "x").collect()
    assert {(r[0], r[1]): r["x"] for r in found} == {
        (a, b): functools.reduce(operator.xor, [i for x, y, i in rows if (x, y) == (a, b)]) for a in range(2) for b in range(5)
    }
    assert fold_by_key(df.limit(0), ["a.b"], "c", lambda a, b: a + b).collect() == []


def test_no_group_holds_more_than_a_batch(spark, monkeypatch):
    """A key with a third of the rows: what is gathered at a time is bounded, and the last step has little left."""
    monkeypatch.setattr(fold, "_BATCH_BITS", 6)
    sizes = []
    plain = F.collect_list
    df = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, -1, id % 1000) as k", "id as v")

    def watched(column):
        sizes.append(column)
        return plain(column)

    monkeypatch.setattr(F, "collect_list", watched)
    assert fold_by_key(df, ["k"], "v", lambda a, b: a + b).filter("k = -1").first()["value"] == sum(range(0, 60_000, 3))
    assert len(sizes) == 3
    # The rounds one by one.
    rows = df
    for _ in range(2):
        rows = rows.sortWithinPartitions("k").withColumn("run", F.shiftright(F.monotonically_increasing_id(), 6))
        groups = rows.groupBy("k", "run").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
        assert groups.agg(F.max("n")).first()[0] <= 64
        rows = groups.select("k", "v")
    assert rows.filter("k = -1").count() < 60
