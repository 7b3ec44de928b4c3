"""Connected components by alternating large and small stars: joins and aggregates only, no driver state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvertide.llm.shared import materialize


def _pairs(*pairs: tuple[str, str]) -> Column:
    """One row (u, v) for each of the pairs of columns."""
    return F.inline(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs]))


def _large(edges: DataFrame) -> DataFrame:
    """Each node joins its larger neighbours to the least of its neighbourhood; edges have u > v."""
    least = edges.select(_pairs(("u", "v"), ("v", "u"))).groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node joins its smaller neighbours and itself to the least of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select(_pairs(("v", "m"), ("u", "m"))).where("u != v").distinct()


def _open(edges: DataFrame) -> int:
    """How many nodes have two roots, or a root and nodes below them; none in a forest of stars."""
    below = edges.withColumns({"one": F.lit(1), "none": F.lit(0)}).select(_pairs(("u", "one"), ("v", "none")))
    return below.groupBy("u").agg(F.sum("v").alias("roots"), F.min("v").alias("least")).where("roots > least").count()


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link (a, b); the root is the least node of the component and has no row itself.

    links should be a stored table. Hub nodes are met by joins after a partial aggregate, so a hub is not gathered in one
    task. Each round is written to the shared folder; rounds end when the edges are a forest of stars.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    while True:
        edges = materialize(_small(_large(edges)), "components")
        if not _open(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
