"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.session import stage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` for each end of the edges ``a, b``: the smallest node reachable.

    In each round every node joins the first of its neighbours and itself, and the graph of
    what they joined goes on, until no edge is left.  Rounds order nodes by value (which
    folds a star in one or two) and by a hash (which shortens a path by a constant factor),
    in turn.  A hot node's neighbours are reduced in map tasks; every step is stored.
    """
    edges = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .distinct(), f"{name}-edges")
    joined, turn = [], 0
    while not edges.isEmpty():
        key = F.xxhash64("v", F.lit(turn)) if turn % 2 else F.col("v")
        ends = edges.select(F.explode(F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
            F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
            F.struct(F.col("a").alias("u"), F.col("a").alias("v")),
            F.struct(F.col("b").alias("u"), F.col("b").alias("v")))).alias("e")).select("e.u", "e.v")
        first = F.min(F.struct(key.alias("key"), "v"))
        step = stage(ends.groupBy("u").agg(first.alias("first")).select("u", F.col("first.v").alias("p")),
                     f"{name}-step")
        a = step.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        b = step.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        edges = stage(edges.join(a, "a").join(b, "b").where("pa <> pb")
                      .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
                      f"{name}-edges")
        joined.append(step)
        turn += 1
    if not joined:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    label = joined[0].select(F.col("u").alias("node"), "p")
    for step in joined[1:]:
        after = step.select(F.col("u").alias("p"), F.col("p").alias("q"))
        label = label.join(after, "p", "left").select("node", F.coalesce("q", "p").alias("p"))
    label = stage(label, f"{name}-labels")
    least = stage(label.groupBy("p").agg(F.min("node").alias("component")), f"{name}-least")
    return label.join(least, "p").select("node", "component")
