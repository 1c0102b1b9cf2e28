"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the least node it is joined to.

    Every round each node takes the least label among its neighbours, then the label of
    its label; the number of rounds grows with the logarithm of the longest chain. Rounds
    are written to the shared folder, so lineage stays short. Only counts reach the
    driver. Links from a node to itself and repeated links do no harm; links with a null
    end are left out.
    """
    ends = F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(
        links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .select(F.explode(ends).alias("e"))
        .select("e.*")
        .distinct(),
        "links",
    )
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels"
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        above = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        following = stage(
            lower.join(above, "label", "left").select(
                "node", "old", F.least("label", "top").alias("label")
            ),
            "labels",
        )
        changed = following.where(F.col("label") != F.col("old")).limit(1).count()
        labels = following.select("node", "label")
        if not changed:
            return labels
