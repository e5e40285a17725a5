"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id that links reach.

    Each round every id takes the smallest label among its neighbours and then the label of that label, so a chain
    halves per round. Labels are written between rounds. Repeated links and links to itself are fine; without links
    the result is empty.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.distinct(), "links")
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        pulled = labels.join(near, labels.id == near.a).select(
            "id", "component", F.least("component", "near").alias("pulled")
        )
        step = materialise(pulled, "labels")
        if step.filter("pulled < component").isEmpty():
            return labels
        above = step.select(F.col("id").alias("_up"), F.col("pulled").alias("_above"))
        labels = materialise(
            step.join(above, step.pulled == above._up).select("id", F.least("pulled", "_above").alias("component")),
            "labels",
        )
