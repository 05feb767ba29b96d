"""Connected components of a link table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clusterio import checkpointed, small_side

#: Rounds are logarithmic in the longest path; a loop that goes on longer is an error.
MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); root: least node reachable.

    Alternating large-star and small-star rounds: every round rewrites the links
    so that each node points to the least neighbour it knows, until no link
    changes.  Links never grow in number, no neighbourhood is collected (only
    minima are taken), and each round is cut off in the shared folder.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = checkpointed(pairs)
    before = None
    for _ in range(MAX_ROUNDS):
        # large-star: each node sends its larger neighbours to its least one
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = small_side(checkpointed(least))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small-star: each node sends its smaller neighbours and itself to the least
        large = checkpointed(large)
        down = small_side(checkpointed(large.groupBy("u").agg(F.min("v").alias("m"))))
        small = large.join(down, "u")
        moved = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = checkpointed(moved.union(down.select("u", F.col("m").alias("v"))).distinct())
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = pairs.select(F.col("v").alias("node")).distinct().join(pairs.select(F.col("u").alias("node")), "node", "left_anti")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root")))
