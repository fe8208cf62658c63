"""Connected components: a distributed union-find over edges of numbers, and over pairs of any type inside groups."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import by_rows, staged, unstaged

#: Edges that one union-find takes at once: bounds a task's memory, whatever its share of the edges.
CHUNK = 250_000


def local_roots(a, b):
    """The distinct nodes of the edges a-b (arrays) and the least node of each one's component, by pointer jumping."""
    import numpy as np

    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    up = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(up[x], up[y]), np.maximum(up[x], up[y])
        np.minimum.at(up, high, low)
        while not np.array_equal(up, higher := up[up]):
            up = higher
        apart = up[x] != up[y]
        x, y = x[apart], y[apart]
    return nodes, nodes[up]


def _contracted(batches: Iterator) -> Iterator:
    """(node, root) of every chunk of edges."""
    import numpy as np
    import pyarrow as pa

    a, b, held = [], [], 0

    def out():
        nodes, roots = local_roots(np.concatenate(a), np.concatenate(b))
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["node", "root"])

    for t in batches:
        a.append(t.column("a").to_numpy(zero_copy_only=False))
        b.append(t.column("b").to_numpy(zero_copy_only=False))
        held += t.num_rows
        if held >= CHUNK:
            yield out()
            a, b, held = [], [], 0
    if held:
        yield out()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root), written, for every node of edges (a, b) of numbers; root is the least node of its component.

    Each round contracts the edges of every chunk to a root for each node, and gathers each node's roots by one shuffle:
    one row a node and chunk, so a node with any number of edges is no hot key. A node with several roots gives the edges
    of the next round, whose nodes are roots only. Each edge is contracted in its chunk, so at least half of the nodes
    vanish in a round; with few chunks, two rounds do. The rounds' tables are joined from the last to the first.

    Self loops, repeated and both ways' edges do no harm; a node that has only a self loop is not returned. Null ends are
    no edges. Empty edges give an empty table.
    """
    rounds, now = [], edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    while True:
        roots = now.mapInArrow(_contracted, "node long, root long").groupBy("node").agg(F.array_sort(F.collect_set("root")).alias("roots"))
        rounds.append(staged(roots, "roots"))
        torn = rounds[-1].filter(F.size("roots") > 1)
        if torn.isEmpty():
            break
        now = torn.select(F.col("roots")[0].alias("a"), F.explode("roots").alias("b")).filter("a <> b")
    found = rounds[-1].select("node", F.col("roots")[0].alias("root"))
    for before in reversed(rounds[:-1]):
        to = found.select(F.col("node").alias("mid"), F.col("root").alias("top"))
        found = before.select("node", F.col("roots")[0].alias("mid")).join(by_rows(to), "mid", "left").select("node", F.coalesce("top", "mid").alias("root"))
    out = staged(found, "components")
    unstaged(*rounds)
    return out


def labelled(pairs: DataFrame) -> DataFrame:
    """(g, node, root) of every node of pairs (g, a, b): a number that the nodes of a component share within their group.

    Nodes of any type are numbered first, so that the union-find deals with numbers. A null group is a group; null nodes
    have none.
    """
    pairs = staged(pairs.select("g", "a", "b").filter("a is not null and b is not null"), "pairs")
    nodes = pairs.select("g", F.col("a").alias("node")).union(pairs.select("g", "b")).distinct()
    nodes = staged(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")

    def numbered(df: DataFrame, end: str) -> DataFrame:
        of = nodes.select(F.col("g").alias("h"), F.col("node").alias("of"), F.col("id").alias(f"{end}_id"))
        return df.join(by_rows(of), F.col("g").eqNullSafe(F.col("h")) & (F.col(end) == F.col("of"))).drop("h", "of")

    edges = numbered(numbered(pairs, "a"), "b").select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    roots = connected_components(edges)
    out = staged(nodes.join(by_rows(roots.withColumnRenamed("node", "id")), "id", "left").select("g", "node", F.coalesce("root", "id").alias("root")), "labels")
    unstaged(pairs, nodes, roots)
    return out
