"""Connected components of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of the links (a, b): the smallest id reachable.

    Each round a node takes the least label of its neighbours, combined inside map
    tasks, and then its label's label. Rounds are written; nothing is gathered."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.filter("a <> b").distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("component")), "labels")
    while True:
        heard = edges.join(labels, edges.b == labels.id).groupBy("a").agg(F.min("component").alias("heard"))
        nearer = labels.join(heard, labels.id == heard.a).select(
            "id", "component", F.least("component", "heard").alias("next")
        )
        roots = labels.select(F.col("id").alias("root"), F.col("component").alias("jump"))
        moved = written(
            nearer.join(roots, F.col("next") == F.col("root"), "left").select(
                "id", F.least("next", F.coalesce("jump", "next")).alias("component"), F.col("component").alias("was")
            ),
            "labels",
        )
        labels = moved.select("id", "component")
        if moved.filter("component <> was").isEmpty():
            return labels
