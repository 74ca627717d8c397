"""Chat formatting with collapse of cumulative snapshots.

A log often holds a conversation several times, each time with more turns. The hash of a
prefix of n turns is the exclusive or of the hashes of (position, role, text) of its turns,
so all prefix hashes of a conversation come from one running window. A conversation whose
hash is that of a proper prefix of a longer one goes; equal ones leave that of the least id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered_turns(df: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text): turns in order, from 1. A turn logged twice counts once; ties
    go by role, then text; null turns come first, null roles and texts are empty. Rows
    without conv_id belong to no conversation."""
    rows = df.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    same = F.col("turn").eqNullSafe(F.lag("turn").over(order)) & (F.col("role") == F.lag("role").over(order))
    again = F.coalesce(same & (F.col("text") == F.lag("text").over(order)), F.lit(False))
    again = again & (F.row_number().over(order) > 1)
    fresh = rows.withColumn("again", again)
    pos = F.sum(F.when(F.col("again"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return fresh.withColumn("pos", pos).where("NOT again").select("conv_id", "pos", "role", "text")


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations to keep; n_copies counts equal ones."""
    order = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    # Two salted hashes make one of 128 bits.
    hashed = [F.xxhash64(F.lit(salt), "pos", "role", "text") for salt in (1, 2)]
    prefixes = turns.select(
        "conv_id",
        "pos",
        *(F.bit_xor(h).over(order).alias(f"h{i}") for i, h in enumerate(hashed)),
        F.lead("pos").over(Window.partitionBy("conv_id").orderBy("pos")).isNull().alias("whole"),
    )
    name = ["pos", "h0", "h1"]
    wholes = prefixes.where("whole").groupBy(*name).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    proper = prefixes.where("NOT whole").select(*name).distinct()
    kept = wholes.join(proper, name, "left_anti")
    return kept.select("conv_id", F.col("pos").alias("n_turns"), "n_copies")


def render(df: DataFrame, begin: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """(conv_id, n_turns, n_copies, text): the kept conversations, one line group per turn. The
    turns of a conversation meet in one row, as its text does."""
    turns = numbered_turns(df)
    kept = maximal_conversations(turns)
    line = F.concat(F.lit(begin), "role", F.lit("\n"), "text", F.lit(end + "\n"))
    joined = turns.select("conv_id", "pos", line.alias("line")).join(kept, "conv_id")
    lines = F.sort_array(F.collect_list(F.struct("pos", "line")))
    texts = joined.groupBy("conv_id", "n_turns", "n_copies").agg(lines.alias("lines"))
    return texts.select("conv_id", "n_turns", "n_copies", F.concat_ws("", F.transform("lines", lambda x: x["line"])).alias("text"))
