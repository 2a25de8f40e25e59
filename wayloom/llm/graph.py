"""Connected components, without collecting links or labels to the driver.

Up to SMALL links, counted first, are joined by one task (16 bytes each); more go
through rounds of alternating stars, whose joins and aggregations are distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Kept, checkpoint


SMALL = 1 << 20


def _join_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) from all links of a bounded table: labels fall to the least neighbour, then jump."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    u, v = (np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)]) for k in (0, 1))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for end in (a, b):
            np.minimum.at(new, end, low)
            np.minimum.at(new, label[end], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "component"])


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them. edges: u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    own = least.select("u", F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60, small: int = SMALL, kept: Kept | None = None) -> DataFrame:
    """(node, component) of all nodes with an edge; a component is its least node. edges: (a, b), any order.

    Every round writes its links to the shared checkpoint folder; rounds grow with the
    logarithm of the longest chain. A node with very many neighbours is combined
    map-side and its join is split like any skewed one. kept: writes the
    links for a caller that knows their number.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = (kept or checkpoint)(edges)
    if edges.count() <= small:
        return edges.coalesce(1).mapInArrow(_join_here, "node bigint, component bigint")
    state = None
    for _ in range(max_rounds):
        edges = checkpoint(_small(_large(edges)))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components didn't settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
