"""Connected components of a table of links, by least-label propagation with pointer jumping.

Labels and links stay tables; each round is written to the shared folder, so a lost executor costs one round. Both sides of
every join are read from written tables, which lets adaptive execution split a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """`links` (a, b) → (node, comp), comp being the least node reachable. Nodes without a link do not appear."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    edges = staged(both.distinct(), "links")
    labels = staged(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        heard = (edges.join(labels, edges["a"] == labels["node"]).groupBy(F.col("b").alias("node")).agg(F.min("comp").alias("heard")))
        lower = staged(labels.join(heard, "node").select("node", "comp", F.least("comp", "heard").alias("low")), "labels")
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("further"))
        moved = staged(lower.join(jump, "low").select("node", F.least("low", "further").alias("next"), "comp"), "labels")
        if not moved.filter("next <> comp").limit(1).count():
            return moved.select("node", F.col("next").alias("comp"))
        labels = moved.select("node", F.col("next").alias("comp"))
