"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every id in ``edges`` (``a, b``: long).

    Each round gives an id the smallest label among its neighbours' and
    then that label's own label, so paths shrink by halves; rounds go on
    until no label changes.  Every round is a written table.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "cc-edges")
    # only the aggregated minimum of a hub's neighbours is shuffled, not its list
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component"))
    labels = stored(labels, "cc-labels")
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id"))
        lower = labels.join(seen.agg(F.min("component").alias("near")), "id")
        lower = lower.select("id", F.col("component").alias("old"), F.least("component", "near").alias("near"))
        jump = labels.select(F.col("id").alias("near"), F.col("component").alias("far"))
        new = stored(lower.join(jump, "near").select("id", "old", F.least("near", "far").alias("component")), "cc-labels")
        changed = new.where("old <> component").limit(1).count()
        labels = new.select("id", "component")
        if not changed:
            return labels
