"""Connected components of a link table, by joins that halve the remaining distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_written, written


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; root is the smallest node reachable.

    Each round every node and its parent take the smallest grandparent among the
    node's neighbours, then parents are short-cut; the number of rounds is
    logarithmic in the longest path for the graphs met here and the loop ends
    when no parent changes. Neighbour minima are combined before they are
    shuffled, so a hub with a third of all links is one key of a partial
    aggregation. Every round is a written table in the shared folder.

    Self links and repeated links are harmless; links with a NULL end are left
    out; no links give no rows.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    edges = written(
        both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    parents = written(
        edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("parent")),
        "parents",
    )
    total = _total(parents)
    while total is not None:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        lifted = parents.join(up, "parent").select("node", "parent", "grand")
        lifted = written(lifted, "lifted")
        near = (
            edges.join(lifted.select(F.col("node").alias("b"), "grand"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("grand").alias("low"))
        )
        offers = near.join(lifted, "node").select(
            F.explode(
                F.array(
                    F.struct(F.col("node"), F.least("low", "grand").alias("parent")),
                    F.struct(F.col("parent").alias("node"), F.least("low", "grand").alias("parent")),
                )
            ).alias("o")
        )
        old = parents
        parents = written(
            offers.select("o.*").groupBy("node").agg(F.min("parent").alias("parent")), "parents"
        )
        drop_written(old, lifted)
        before, total = total, _total(parents)
        if total == before:
            break
    drop_written(edges)
    return parents.select("node", F.col("parent").alias("root"))


def _total(parents: DataFrame):
    """Parents only ever fall, so an unchanged sum means that none has changed."""
    return parents.agg(F.sum(F.col("parent").cast("decimal(38,0)"))).first()[0]
