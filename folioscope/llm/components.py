"""Connected components of a graph that does not fit one machine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import checkpointed


def _mark(links: DataFrame) -> tuple:
    """Number and order-free sum of the rows; equal only when nothing changed."""
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of ``edges (a, b)`` that has a partner.

    The component is its smallest node.  Large-star and small-star steps in
    turn: each hangs neighbours under the smallest one around, so the number of
    edges never grows and the trees become stars after a few rounds (of the
    order of the squared logarithm of the nodes).  Each round is checkpointed.
    Minima are pre-aggregated; a node with very many edges sits only in joins,
    which Spark may split.
    """
    links = checkpointed(
        edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").filter("a <> b").distinct()
    )
    mark = _mark(links)
    while mark[0]:
        both = links.union(links.selectExpr("b AS a", "a AS b"))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
        large = both.filter("b > a").join(smallest, "a").selectExpr("b AS a", "m AS b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").selectExpr("b AS a", "m AS b").filter("a <> b")
        links = checkpointed(small.union(lowest.selectExpr("a", "m AS b")).distinct())
        before, mark = mark, _mark(links)
        if mark == before:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.selectExpr("a AS node", "b AS component").union(roots)


def smallest_of_component(groups: DataFrame, ids: DataFrame) -> DataFrame:
    """``groups (node, component)`` with ``label``, the smallest id that ``ids (node, id)`` has in the component."""
    labels = checkpointed(
        groups.join(ids, "node").groupBy("component").agg(F.min("id").alias("label"))
    )
    return groups.join(labels, "component").select("node", "component", "label")


def join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite the classes of ``i`` and ``j`` pairwise; ``label[x]`` is the smallest index of x's class."""
    while True:
        low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
        apart = low != high
        if not apart.any():
            return
        np.minimum.at(label, high[apart], low[apart])
        while True:
            further = label[label]
            if (further == label).all():
                break
            label[:] = further
