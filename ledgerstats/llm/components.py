"""Connected components of a graph that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstats.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of `edges` (u, v); the component is its smallest node.

    In turn, every node hands its larger neighbours, then its smaller ones, to the smallest
    node it knows, until each is tied to its component's smallest alone. The number of rows
    never grows beyond that of the edges, and a node with many neighbours is an aggregation
    with partial results and a join that adaptive execution splits.
    """
    edges = written(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), "m").distinct()
        large = large.withColumnRenamed("m", "v")
        # Every node but a smallest one now points to smaller nodes only.
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(first, "u")
        edges_next = (
            small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        edges = written(edges_next, "edges")
        state, before = _state(edges), state
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
