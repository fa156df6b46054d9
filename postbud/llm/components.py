"""Connected components of a table of links, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postbud.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node``, ``class`` for every node in ``links`` (a, b): class is the least node reached.

    Every round takes the least class among neighbours and then the class of that class, so
    chains halve each time and a star of any size takes one round. Rounds are written to the
    shared folder, which cuts lineage; sums are combined before the shuffle, so a node with very
    many links is no single task's work.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both, "links")
    state = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("class"))
    state = stage(state.select("node", F.least("node", "class").alias("class")), "classes")
    while True:
        near = (
            both.join(state, both["b"] == state["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("class").alias("near"))
        )
        step = state.join(near, "node").select(
            "node", F.least("class", "near").alias("class"), F.col("class").alias("was")
        )
        step = stage(step, "classes")
        heads = step.select(F.col("node").alias("class"), F.col("class").alias("head"))
        step = stage(
            step.join(heads, "class").select("node", F.col("head").alias("class"), "was"), "classes"
        )
        if step.where(F.col("class") != F.col("was")).isEmpty():
            return step.select("node", "class")
        state = step.select("node", "class")
