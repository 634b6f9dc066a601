"""Connected components of a table of links, by alternating large and small stars."""
from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import written


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of a task shortened to (node, smallest node reached by them), so that few rows leave it."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[one], root[two])
        new = root.copy()
        np.minimum.at(new, root[one], low)
        np.minimum.at(new, root[two], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of a link to another: the smallest node reachable from it.

    Each round joins every node's links to the least of its neighbours; all steps are joins and mergeable minima, so a
    node with very many links is split like any hot key. Rounds end when the links no longer change; their number
    grows with the logarithm of the longest chain. Nodes without links, links from a node to itself and null ends give
    no row.
    """
    tag = uuid.uuid4().hex[:6]

    def down(df: DataFrame) -> DataFrame:
        return (df.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    edges = written(down(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), f"links-{tag}")
    state = None
    for turn in range(60):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(down(large), f"large-{tag}-{turn}")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select("u", "v", "m")
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lowest.select("u", F.col("m").alias("v")))
        edges = written(down(edges), f"small-{tag}-{turn}")
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
    raise RuntimeError("links still change after 60 rounds")
