"""Connected components of a link table, as rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of longs -> (v, root): each linked value and the smallest it reaches.

    A round lowers each vertex's and its root's label to the smallest label among
    its neighbours (a minimum per key, combined before the shuffle, so a vertex with
    very many links is no hot key), then follows labels one step further.  Each
    round is written to the shared folder; the last changes nothing.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("root")), "labels")
    while True:
        seen = (
            both.join(labels.withColumnRenamed("v", "b"), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("root").alias("lowest"))
        )
        known = labels.join(seen, "v")
        offers = known.select("v", "lowest").union(known.select(F.col("root").alias("v"), "lowest"))
        lowered = (
            labels.join(offers.groupBy("v").agg(F.min("lowest").alias("lowest")), "v")
            .select("v", F.least("root", "lowest").alias("root"))
        )
        lowered = stored(lowered, "labels")
        step = lowered.select(F.col("v").alias("root"), F.col("root").alias("next"))
        following = stored(
            lowered.join(step, "root").select("v", F.col("next").alias("root")), "labels"
        )
        moved = following.join(labels.withColumnRenamed("root", "before"), "v").filter("root <> before")
        if moved.isEmpty():
            return following
        labels = following
