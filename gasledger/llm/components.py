"""Connected components of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gasledger.llm.common import stored


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(id, comp) for every end of the links (a, b); comp is the smallest id reachable.

    With ``rounds`` the search stops after so many: equal labels are still
    connected, but a component may keep several.

    Each round takes the smallest label over a vertex's links (pre-aggregated,
    so a vertex of many links gathers nothing) and then the label's own label.
    """
    edges = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low"))
                    .select("id", F.least("id", "low").alias("comp")), "labels")
    while True:
        low = (edges.join(labels.withColumnRenamed("id", "b"), "b")
               .groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("low")))
        hop = labels.join(low, "id").select("id", F.least("comp", "low").alias("comp"), F.col("comp").alias("was"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("far"))
        new = stored(hop.join(jump, "comp", "left").select("id", F.least("comp", "far").alias("comp"), "was"), "labels")
        labels = new.select("id", "comp")
        rounds = None if rounds is None else rounds - 1
        if rounds == 0 or new.where("comp <> was").isEmpty():
            return labels
