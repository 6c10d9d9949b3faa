"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root``: for every node that has a link to another, the smallest node it can reach.

    Each round every node points at its smallest neighbour, pointers are shortened until they reach a root, and the
    links are drawn anew between roots. A round at least halves the number of nodes that still have links, so rounds
    grow with the logarithm of the graph; a node with very many links costs one pre-aggregated minimum. Null ends are
    dropped.
    """
    links = keep(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b").distinct(),
        "links",
    )
    roots: DataFrame | None = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), "points")
        moving = True
        while moving:
            beyond = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = keep(points.join(beyond, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "points")
            moving = not jumped.where("moved").isEmpty()
            points = jumped.select("node", "root")
        at = {end: points.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")) for end in "ab"}
        drawn = links.join(at["a"], "a").join(at["b"], "b")
        links = keep(drawn.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).where("a <> b").distinct(), "links")
        if roots is None:
            roots = points
        else:
            later = points.select(F.col("node").alias("root"), F.col("root").alias("final"))
            known = roots.join(later, "root", "left").select("node", F.coalesce("final", "root").alias("root"))
            roots = keep(known, "roots")
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
