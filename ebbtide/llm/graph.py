"""Connected components of a link table, by contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import written


def _roots(parents: DataFrame) -> DataFrame:
    """Pointer jumping: every node with the end of its chain of parents (node, root)."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = written(
            parents.join(up, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root"), (F.col("next") < F.col("root")).alias("moved")
            ),
            "roots",
        )
        parents = jumped.select("node", "root")
        if not jumped.where("moved").take(1):
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node it reaches.

    Every round hooks each node to its smallest neighbour and contracts the links to the roots,
    so the number of nodes that still have links at least halves. All tables are written.
    """
    links = links.where("a <> b")
    labels = None
    while True:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("root")
        )
        roots = _roots(written(parents, "parents"))
        if labels is None:
            labels = roots
        else:
            onward = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = written(
                labels.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels"
            )
        of_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        of_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        links = written(
            links.join(of_a, "a").join(of_b, "b").where("root_a <> root_b")
            .select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(),
            "contracted",
        )
        if not links.take(1):
            return labels
