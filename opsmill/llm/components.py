"""Connected components of a table of links, by least labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmill.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(id, comp) for every id in ``links`` (src, dst): the least id reachable.

    Each round takes the least label among the neighbours, then the label of
    that label, and is written to the shared folder, so lineage stays short and
    a lost executor costs one round. A node with very many links is split by
    the join and pre-aggregated; nothing of the graph goes through the driver.
    """
    both = materialise(links.select("src", "dst").union(links.select("dst", "src")).distinct(), "links")
    first = both.groupBy("src").agg(F.least("src", F.min("dst")).alias("comp"))
    labels = materialise(first.select(F.col("src").alias("id"), "comp"), "labels")
    while True:
        near = (both.join(labels, both["dst"] == labels["id"]).groupBy("src").agg(F.min("comp").alias("near")))
        step = labels.join(near, labels["id"] == near["src"]).select("id", "comp", F.least("comp", "near").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("comp").alias("far"))
        made = materialise(step.join(jump, "next", "left").select(
            "id", F.col("comp").alias("old"), F.least("next", F.coalesce("far", "next")).alias("comp")), "labels")
        labels = made.select("id", "comp")
        if made.where("old != comp").isEmpty():
            return labels
