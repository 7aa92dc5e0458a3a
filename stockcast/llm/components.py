"""Connected components over an edge table, by forests of whole partitions.

A level takes three steps:

1. Every task folds its edges into a forest and gives it out as stars (node, smallest
   node of its tree): no more rows than nodes, whatever the edges.
2. Stars of one node from several tasks meet: the node takes its smallest root, and
   roots it had besides are joined with that one by new edges. A node holds at
   most one root a task (and piece of a forest).
3. Nodes that are roots elsewhere hand their own root on in the same way.

The new edges run between roots only; they are the next level's. The levels end when
there are none, which takes one level per halving at most and in practice two or three,
as edges of a level that fit one task are settled by it. The labels are then
read from the last level back. A component may hold any share of the nodes: labels
are looked up by (label, piece of its nodes), never by the label alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import spread_join, stored

#: Nodes of a forest held by a task; a larger one is given out in pieces.
HELD = 1 << 20
#: Edges that one task settles.
AT_ONCE = 1 << 18


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node of the edges, root the smallest node of its tree."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        if np.array_equal(rx, ry):
            return nodes, nodes[root]
        low, high = np.minimum(rx, ry), np.maximum(rx, ry)
        np.minimum.at(root, high, low)
        while not np.array_equal(up := root[root], root):
            root = up


def _stars(batches):
    """(a, b): the stars of the forest of all of a task's edges, node a under root b."""
    kept = [np.zeros((2, 0), np.int64)]  # the forest so far, then edges not yet folded in
    waiting = 0

    def folded():
        node, root = forest(*np.concatenate(kept, axis=1))
        return np.stack([node, root])[:, node != root]

    def given(stars):
        for k in range(0, stars.shape[1], 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(stars[0, k : k + (1 << 16)]), pa.array(stars[1, k : k + (1 << 16)])], ["a", "b"])

    for batch in batches:
        if batch.num_rows:
            kept.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))
            waiting += batch.num_rows
        if waiting > max(1 << 16, kept[0].shape[1]):
            kept, waiting = [folded()], 0
            if kept[0].shape[1] > HELD:
                yield from given(kept[0])
                kept = [np.zeros((2, 0), np.int64)]
    yield from given(folded())


def thinned(edges: DataFrame) -> DataFrame:
    """Edges (a, b) that join the same nodes, at most one a node and task. No exchange."""
    return edges.mapInArrow(_stars, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> (node long, component long): the smallest node
    reachable from each node that has an edge. Loops and repeats are allowed;
    edges with a null end are left out."""
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    levels = []
    while True:
        stars = thinned(edges).groupBy("a").agg(F.collect_set("b").alias("roots"))
        level = stored(stars.select(F.col("a").alias("node"), F.array_min("roots").alias("root"), F.array_except("roots", F.array(F.array_min("roots"))).alias("rest")), "component-level")
        levels.append(level.select("node", "root"))
        roots = level.select(F.explode(F.concat(F.array("root"), "rest")).alias("node")).distinct()
        handed = level.join(roots, "node", "left_semi").select(F.col("node").alias("a"), F.col("root").alias("b"))
        met = level.select(F.explode("rest").alias("a"), F.col("root").alias("b"))
        edges = stored(met.union(handed).distinct(), "component-edges")
        left = edges.count()
        if not left:
            break
        edges = edges.coalesce(-(-left // AT_ONCE))
    labels = levels.pop().select("node", F.col("root").alias("component"))
    while levels:
        level = levels.pop()
        above = labels.select(F.col("node").alias("root"), "component")
        known = spread_join(level, above, ["root"], "node").select("node", F.coalesce("component", "root").alias("component"))
        # a root's own label comes from the levels above
        below = known.join(labels.select("node"), "node", "left_anti")
        labels = stored(below.union(labels), "component-labels")
    smallest = labels.select("component").distinct()
    return labels.union(smallest.select(F.col("component").alias("node"), "component"))
