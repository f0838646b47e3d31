"""Connected components of a link table by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Link each node's neighbours to the least of the node and its neighbours.

    ``both``: neighbours on either side, of which the larger ones move (large
    star); else the smaller neighbours only, which all move (small star).
    Edges are (u, v) with u < v.
    """
    if both:
        near = edges.select(F.col("u").alias("n"), F.col("v").alias("m")).unionByName(
            edges.select(F.col("v").alias("n"), F.col("u").alias("m")))
    else:
        near = edges.select(F.col("v").alias("n"), F.col("u").alias("m"))
    # written first: AQE can split a hub's rows in a join with a table, not in one with an aggregate
    least = materialise(near.groupBy("n").agg(F.min("m").alias("_m"))
                        .select(F.col("n").alias("k"), F.least("n", "_m").alias("least")), "least")
    met = near.join(least, F.col("n") == F.col("k"))
    if both:
        moved = met.filter(F.col("m") > F.col("n")).select(F.col("least").alias("u"), F.col("m").alias("v"))
    else:
        moved = met.select(F.col("least").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("least").alias("u"), F.col("k").alias("v")))
    return moved.filter("u < v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``edges`` (u, v longs); component = its least node.

    Each round is written to the shared folder.  Rounds grow with the logarithm
    of a component's size.  Minima are combined before their shuffle and written,
    so the rows of a hub, or of a component's root in late rounds, are split over
    tasks by AQE's skew handling; no list of neighbours is ever built.
    """
    now = materialise(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                      .filter("u < v").distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
        now = materialise(_star(_star(now, True), False), "edges")
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
