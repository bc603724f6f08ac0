"""Connected components of a table of links, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from strandlog.llm import common


def connected(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``links`` (a, b).

    Alternates large-star and small-star rounds until nothing changes: each round keeps at most as many
    links as there were, and a component of any shape ends as a star in a logarithmic number of rounds. A
    node of many links is one key only of aggregates; the joins leave its links where they are. Every
    round is written to the shared folder, so a lost executor costs at most one round.
    """
    clean = links.where("a != b and a is not null and b is not null")
    now = common.materialize(clean.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    state = _state(now)
    while state[0]:
        # Large star: every larger neighbour of a node goes to the smallest of its neighbourhood.
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # A node has no more links after the large star than before, so these are all hot keys of the round.
        degrees = common.materialize(both.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > common.HOT_ROWS), "stars-hot")
        hot = common.hot_keys(degrees, "u")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = common.spread_join(both, low, "u", hot).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = common.spread_join(large, least, "u", hot).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("s")).select("s.u", "s.v")
        before, now = now, common.materialize(small.where("u != v").distinct(), "stars")
        common.free(before, degrees)
        was, state = state, _state(now)
        if state == was:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(links: DataFrame) -> Row:
    """How many links there are, and a sum of their hashes."""
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
