"""Connected components of a table of links: by alternating stars, every step written and reread; a counted few
links are followed in one task."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from usagemart.llm.rows import stored


FEW_LINKS = 200_000  # of some megabytes


def _followed(batches):
    """(node, root) of the links of one task."""
    parent: dict = {}

    def root(node):
        path = []
        while parent.setdefault(node, node) != node:
            path.append(node)
            node = parent[node]
        for passed in path:
            parent[passed] = node
        return node

    kind = pa.null()
    for batch in batches:
        kind = batch.column("a").type
        for a, b in zip(*(column.to_pylist() for column in batch.columns)):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array(map(root, nodes), kind)], ["node", "root"])


def _linked(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that ``links`` (a, b) name; the root is the least of its component.

    Each round points the greater neighbours of a node at its least one (large star), then every node
    and its lesser neighbours at the least of those (small star), until nothing changes. Minima are
    combined before they are shuffled, and the joins are such that a hub's links can be split.
    """
    if links.count() <= FEW_LINKS:
        kind = links.schema["a"].dataType
        found = _linked(links.select("a", "b")).repartition(1)
        return found.mapInArrow(_followed, T.StructType([T.StructField("node", kind), T.StructField("root", kind)]))
    edges = stored(_linked(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))),
                   "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _linked(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = stored(_linked(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                               .unionByName(least.select("a", F.col("m").alias("b")))), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
