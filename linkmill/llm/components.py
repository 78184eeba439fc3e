"""Connected components over an edge table, as alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.session import scratch_path, written, written_with


def _min_by_node(pairs: DataFrame) -> DataFrame:
    """Pairs (node, other) joined with the smallest of each node's others; the minimum combines map-side.

    The minima are written first, so the join has an exchange of its own on both sides and a node with very many
    pairs can be split by the adaptive skew handling instead of meeting in one task.
    """
    least = written(pairs.groupBy("node").agg(F.min("other").alias("least")), "star-min")
    return pairs.join(least, "node")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the smallest of the node and its neighbours."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    return (
        _min_by_node(both)
        .where("other > node")
        .select(F.col("other").alias("a"), F.least("node", "least").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour not larger than a node, and the node itself, is linked to the smallest of them."""
    down = _min_by_node(edges.select(F.col("a").alias("node"), F.col("b").alias("other")))
    return (
        down.select(F.explode(F.array(F.struct(F.col("other").alias("a"), F.col("least").alias("b")),
                                      F.struct(F.col("node").alias("a"), F.col("least").alias("b")))).alias("e"))
        .select("e.a", "e.b")
        .where("a <> b")
        .distinct()
    )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of an undirected edge table; ``component`` is the smallest node reached.

    Rows with a null end and loops are ignored, repeated edges count once, and an empty table gives no rows. Each
    round is written to the shared folder, which cuts the lineage. No round gathers a component anywhere: a round
    moves edges, of which there are never more than at the start. It ends when the edges form stars.
    """
    spark = edges.sparkSession
    pairs = (
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
        .where("x is not null and y is not null and a <> b")
        .select("a", "b")
        .distinct()
    )
    current, state = written_with(pairs, scratch_path(spark, "star"), _state())
    while state and state[0]:
        following = written(_large_star(current), "star-large")
        following, new_state = written_with(_small_star(following), scratch_path(spark, "star"), _state())
        if new_state == state:
            break
        current, state = following, new_state
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b"), F.col("b")).distinct()
    )


def _state():
    """A number of edges and an order-free digest of them: equal states mean that nothing changed any more."""
    return F.array(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31)))
