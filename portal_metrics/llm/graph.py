"""Connected components of an edge table by alternating large-star and small-star rounds.

No neighbour list is ever gathered: a round takes each node's least neighbour with a
partial aggregation and joins it back to the edges, so a hub with a third of all
edges is combined map-side and its join rows can be split by AQE.  Every round is
written to the shared scratch folder (lineage cut, executors may be lost).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portal_metrics.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, root) for every id of ``edges`` (columns a, b: long): root is the least id of its component."""
    def ordered(e):
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    edges = saved(ordered(edges))
    before = _state(edges)
    for _ in range(most_rounds):
        if not before[0]:
            break
        # large star: every larger neighbour points at the least neighbour
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = saved(ordered(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))))
        # small star: the node and its smaller neighbours point at the least of them
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        edges = saved(ordered(edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                              .union(least.select("a", F.col("m").alias("b")))))
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct().toDF("id", "root"))
