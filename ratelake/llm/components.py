"""Connected components of links between 64-bit keys, by large star and small star in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import staged


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's neighbours (the larger ones, or the others with itself) to the least of them."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(least, "a")
    if large:
        linked = linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return linked.filter("a <> b").distinct()


def components(edges: DataFrame, name: str = "components", rounds: int = 100) -> DataFrame:
    """(node, root) for every node of the links (a, b), root being the least node reachable.

    Links may repeat, point either way or to themselves. Each round is written to the shared folder, so
    the plan stays short and a lost executor costs one round. Hubs are joined where Spark splits hot keys.
    Every round ends in stars after about log n rounds; more than `rounds` is an error, not a result.
    """
    current = staged(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name
    )
    state = None
    for _ in range(rounds):
        step = staged(_stars(_stars(current, True), False), name)
        sums = step.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sums) == state:
            return step.select(F.col("a").alias("node"), F.col("b").alias("root"))
        current, state = step, tuple(sums)
    raise RuntimeError(f"links are not joined after {rounds} rounds")
