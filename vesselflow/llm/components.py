"""Connected components of links between nodes, by contraction, with no group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesselflow.llm.stage import join_groups, staged


#: So many parents (two ids each) at most are broadcast.
FEW = 50_000


def follow(rows: DataFrame, column: str, parents: DataFrame, few: bool = False) -> DataFrame:
    """``rows`` with the nodes in ``column`` replaced by their parents, where they have one. ``few`` parents are broadcast.
    Else a node in many rows is no hot key: those above a thousandth of the rows are joined by broadcast."""
    others = [c for c in rows.columns if c != column]
    to = parents.select(F.col("node").alias(column), F.col("parent").alias("__to"))
    if few:
        out = rows.join(F.broadcast(to), column, "left")
    else:
        uses = rows.groupBy(column).agg(F.count(F.lit(1)).alias("__uses"))
        out = join_groups(rows, staged(uses.join(to, column), "parents"), [column], "__uses")
    return out.select(*others, F.coalesce("__to", column).alias(column))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the component's smallest node) of each node in ``links`` (``a``, ``b``).

    Each round every node hooks onto its smallest neighbour below itself, chains are halved to their roots, and links
    are moved to the roots; what remains are links between roots, fewer each round. Tables of each round are staged.
    """
    links = staged(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "links"
    )
    nodes = staged(links.select(F.col("a").alias("node")).union(links.select("b")).distinct(), "link-nodes")
    labels = nodes.select("node", F.col("node").alias("label"))
    while n := links.count():
        few = n <= FEW  # a round has no more parents than links
        parents = staged(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent")), "hooks")
        while True:
            up = staged(follow(parents.withColumn("was", F.col("parent")), "parent", parents, few).select("node", "parent", "was"), "hooks")
            moved = not up.where("parent != was").isEmpty()
            parents = up.drop("was")
            if not moved:
                break
        labels = staged(follow(labels, "label", parents, few).select("node", "label"), "labels")
        moved_a = follow(links, "a", parents, few).select("a", "b")
        moved_b = follow(moved_a if few else staged(moved_a, "links"), "b", parents, few)
        links = staged(
            moved_b.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "links"
        )
    return labels
