"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (columns a, b); component is the least node
    connected with it.

    Each round ranks nodes by degree (ties by a hash that changes with the round) and maps each
    to the first of its neighbours and itself; then these maps are followed twice. Stars
    vanish at once, and of any graph an expected constant share of the nodes. A round writes
    two narrow tables; only whether edges are left reaches the driver.
    """
    live = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    state = live.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    state = state.withColumn("root", F.col("node"))
    step = 0
    while not live.isEmpty():
        step += 1
        both = live.select(F.explode(F.expr("array(struct(a AS x, b AS y), struct(b AS x, a AS y))")).alias("e"))
        both = both.select("e.x", "e.y")
        degrees = both.groupBy("x").agg(F.count("*").alias("d"))
        order = F.struct((-F.col("d")).alias("d"), F.xxhash64(F.lit(step), "x").alias("h"), F.col("x").alias("id"))
        ranked = degrees.select("x", order.alias("rank"))
        best = (
            both.join(ranked.select(F.col("x").alias("y"), "rank"), "y")
            .groupBy("x")
            .agg(F.min("rank").alias("best"))
            .join(ranked, "x")
            .select("x", F.least("best", "rank").getField("id").alias("to"))
        )
        maps = stored(best, "maps")
        for _ in range(2):
            further = maps.select(F.col("x").alias("to"), F.col("to").alias("next"))
            maps = maps.join(further, "to").select("x", F.col("next").alias("to"))
        for side in ("a", "b"):
            live = live.join(maps.withColumnRenamed("x", side), side).drop(side).withColumnRenamed("to", side)
        pair = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        live = stored(live.where("a <> b").select(*pair).distinct(), "edges")
        state = state.join(maps.withColumnRenamed("x", "root"), "root", "left").select(
            "node", F.coalesce("to", "root").alias("root")
        )
    if step:
        state = stored(state, "roots")
    least = state.groupBy("root").agg(F.min("node").alias("component"))
    return state.join(least, "root").select("node", "component")
