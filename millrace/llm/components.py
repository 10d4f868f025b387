"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.shared import stored


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node`` and ``component``, the smallest node that can be reached, for nodes with a link.

    ``links`` has columns ``a`` and ``b``; direction and repeats do not matter. Each round links
    every node and its neighbours to the smallest neighbour (first for larger neighbours, then for
    smaller ones), which halves the length of paths; a round's links are stored, so that lineage
    stays short and lost executors cost single tasks. Only a count comes to the driver. Nodes with
    very many links are handled by joins and partial minima, never as a group. Links of a null are none.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.distinct(), "links")
    mark = _mark(links)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        # Large star: neighbours above u go to the smallest of u and its neighbours.
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "large-star")
        # Small star: u and its smaller neighbours go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(low.select("a", F.col("m").alias("b")))
            .filter("a <> b")
        )
        links = stored(small.distinct(), "small-star")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _mark(links: DataFrame) -> tuple[int, int | None]:
    """Tells one set of links from another."""
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]
