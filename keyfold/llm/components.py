"""Connected components of a graph of links, on edge tables alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import stored


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``, integers), ``root`` being the smallest of its component, stored.

    Alternating stars: every node hands its larger neighbours to its smallest one, then its smaller neighbours too,
    until only stars are left. The edges become fewer, never more, and no node's neighbours are
    gathered: minima are added up before the shuffle and joined back.

    ``known`` is what this gave for other links, which count too; its components are single nodes here, so only what joins them is
    worked on.
    """
    if known is None:
        return stored(_stars(links), "labels")
    joining = stored(_named_by(_named_by(links, "a", known), "b", known).filter("a != b"), "links")
    if joining.isEmpty():
        return known
    found = _stars(joining)
    moved = _named_by(known, "root", found).select("node", "root")
    return stored(moved.unionByName(found.join(known, "node", "left_anti")), "labels")


def _named_by(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """``rows`` with the root of the node in ``column`` in its place, if it has one."""
    roots = labels.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return rows.join(roots, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")


def _stars(links: DataFrame) -> DataFrame:
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links"
    )
    while not _settled(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or larger ones, never both: the smaller one is its component's smallest then."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("smaller"), F.lit(1).alias("larger"))
    )
    both = ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return not both.agg(F.max((F.col("smaller") > 1) | ((F.col("smaller") > 0) & (F.col("larger") > 0)))).first()[0]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m")).select("of", F.least("of", "m").alias("m"))
    return both.join(least, both["u"] == least["of"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"))
    # the node itself goes to its smallest neighbour with the edge that says so
    moved = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u")
    return edges.join(least, edges["u"] == least["of"]).select(moved, F.col("m").alias("v")).distinct()
