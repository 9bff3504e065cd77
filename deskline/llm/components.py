"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskline.llm.common import saved


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``links``.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), each a
    grouped minimum and a join on the node, until the links no longer change: a number
    of rounds in the logarithm of the size, each over no more links than before. Before,
    each batch of links is replaced by stars. Every round is saved to the shared folder. Loops, repeated and null links are ignored; no
    links give no rows. A node with most of the links is split by the skew join.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    # Each task replaces its links by a star for each component they form.
    edges = saved(edges.mapInArrow(_contract, "u long, v long"))
    before = None
    while True:
        edges = saved(_small_star(_large_star(edges)))
        now = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars instead of the links of each batch."""
    for batch in batches:
        u, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = np.arange(len(nodes))
        ends = place.reshape(2, -1)
        while True:
            # Roots of links meet in the smaller one, and all point to their root.
            low, high = np.sort(root[ends], axis=0)
            if (low == high).all():
                break
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["u", "v"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its
    neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return moved.union(smallest.select("u", F.col("m").alias("v"))).distinct()
