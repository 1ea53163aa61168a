"""Connected components by minimum labels and pointer jumping, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import cut


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(key, root) of every key in ``edges`` (a, b); root is the least key of the component.

    Each round gives every key the least root among its neighbours' and its own, hooks
    the old root to it, and follows roots once more, so labels move along paths of
    doubling length.  Group sizes do not matter: neighbours meet through a partial
    aggregation, and nothing is collected but one count a round.
    """
    one = edges.where("a <> b").select("a", "b")
    both = cut(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("key"), F.least("a", "m").alias("root")))
    for _ in range(rounds):
        near = (both.join(label, F.col("b") == F.col("key")).groupBy("a").agg(F.min("root").alias("m")))
        step = label.join(near, F.col("key") == F.col("a"), "left").select("key", "root", F.least("root", "m").alias("m"))
        hooks = step.groupBy("root").agg(F.min("m").alias("h")).select(F.col("root").alias("r"), "h")
        hooked = step.join(hooks, F.col("root") == F.col("r"), "left").select("key", "root", F.least("m", "h").alias("n"))
        up = hooked.select(F.col("key").alias("k2"), F.col("n").alias("n2"))
        new = cut(hooked.join(up, F.col("n") == F.col("k2"), "left")
                  .select("key", F.least("n", "n2").alias("new"), (F.least("n", "n2") != F.col("root")).alias("moved")))
        moved = new.where("moved").limit(1).count()
        label = new.select("key", F.col("new").alias("root"))
        if not moved:
            return label
    raise RuntimeError(f"components did not settle in {rounds} rounds")
