"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every node's larger (or smaller) neighbours to the least node around it.

    The least neighbour is a pre-aggregated minimum that is joined back, so the neighbours of a hub are
    never gathered, and a join can be split where a hub is hot.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("_m"))
    least = least.select(F.col("a").alias("_a"), F.least("a", "_m").alias("_m"))
    joined = both.join(least, F.col("a") == F.col("_a"))
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("_m").alias("b")).union(least.select(F.col("_a").alias("a"), F.col("_m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; the component is its least node.

    Links may come in any direction and repeat; null ends and loops are ignored.  Each round is written to
    the shared checkpoint folder.  Rounds grow with the logarithm of the longest chain.
    """
    current = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    current = cut_lineage(current)
    before = None
    while True:
        current = cut_lineage(_star(_star(current, True), False))
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
