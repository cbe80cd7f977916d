"""Connected components of a graph given by its edges, all of it in shuffles of bounded groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import BROADCAST_ROWS, discard, look_up, stored


def components(edges: DataFrame, whole: int = BROADCAST_ROWS) -> DataFrame:
    """(node, root) for each node of the edges (a, b): root is the least node of its component.

    Large-star and small-star steps in turn (Kiveris et al., 2014) until only stars are left.  A step takes each
    node's least neighbour with map-side combining and gives it back to the node's edges by look_up(): nodes with over a
    thousandth of all edges by broadcast, so the edges of a hot node stay where they are, the others by a shuffle.  One table
    of the nodes serves the check for stars and the next step.  A round is written once, by its distinct edges.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = F.count(F.when(F.col("b") < F.col("a"), 1))
        nodes = stored(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"), up.alias("up")), "nodes")
        # a star: each node with a lesser neighbour has no other one.  Steps keep what is connected, so stars are components
        if nodes.filter("up > 0 and n > 1").isEmpty():
            discard(nodes)
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        of = 2 * edges.count()
        large = look_up(both.filter("b > a"), nodes.select("a", "m", "n"), "a", "n", of, whole)
        large = large.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).filter("a <> b")  # repeats go with the write
        lowest = stored(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "lowest")
        pairs = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))
        small = look_up(large, lowest, "a", "n", of, whole).select(F.inline(pairs))
        nxt = stored(small.filter("a <> b").distinct(), "edges")
        for t in (edges, nodes, lowest):
            discard(t)
        edges = nxt
