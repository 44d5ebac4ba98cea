"""Graph operators on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.checkpoints import materialise


#: A node is hot that has more edges than a task should read, and more than this share of all; and so many sub-stars are its edges dealt to.
HOT_EDGES, HOT_SHARE, SUB_STARS = 1_000_000, 0.002, 64


def _with_nearest(edges: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Edges with `m`: the smallest node of u and its neighbours v. Edges of hot nodes are dealt to sub-stars by their
    other end: each finds its minimum, a second minimum is taken over them, and goes back to every sub-star."""
    if hot is None:
        return edges.join(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "u")
    dealt = edges.join(F.broadcast(hot), "u", "left").withColumn("sub", F.when(F.col("hot"), F.pmod(F.xxhash64("v"), F.lit(SUB_STARS))).otherwise(0)).drop("hot")
    subs = dealt.groupBy("u", "sub").agg(F.min("v").alias("v"))
    whole = subs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return dealt.join(subs.select("u", "sub").join(whole, "u"), ["u", "sub"]).drop("sub")


def _hot(both: DataFrame, n: int, hot_edges: int) -> DataFrame | None:
    """The hot nodes of n edges, each there from both its ends: 2 / HOT_SHARE of them at most. None where no node can be."""
    limit = max(hot_edges, n * HOT_SHARE)
    return None if n <= limit else both.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("u", F.lit(True).alias("hot"))


def connected_components(edges: DataFrame, src: str, dst: str, max_rounds: int = 60, hot_edges: int = HOT_EDGES) -> DataFrame:
    """Every node that has an edge, with the smallest node of its component: (node, component).

    Alternates the two star operations: each node links its larger neighbours, then its smaller ones, to the
    smallest node it sees, until the edges form stars. Edges never outgrow the input, nothing is gathered per
    node (a minimum and a join, not a list), and each round ends in a table in the shared folder. Nodes with more than
    `hot_edges` edges and a share of all are split, so that a component of any size spreads over tasks.
    Null ends and self-loops give no link; a node known only from self-loops is its own component. Repeated
    edges are harmless; an empty table gives an empty result.
    """
    ends = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    alone = ends.where("u = v").select("u", "v")
    now = materialise(ends.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before, n = None, now.count()
    for _ in range(max_rounds):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hot = _hot(both, n, hot_edges)
        large = _with_nearest(both, hot).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _with_nearest(large, hot)
        now = materialise(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(),
            "edges",
        )
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before, n = state, state.n
    else:
        raise RuntimeError(f"components not stable after {max_rounds} rounds")
    roots = now.select(F.col("v").alias("u"), "v")
    return (
        now.unionAll(roots).unionAll(alone).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    )
