"""Shards of bounded size by extendible hashing.

A row's hash is 128 bits in groups of 16: 64 of its key, then 64 of its whole content, so rows
of one hot key can still be told apart. The directory starts with one bucket; only buckets over
the limit split on their next bit. All splits within one group of bits follow from one sum
of bytes per value of the group (at most 65,536 values under a parent); after the first group
only the rows of buckets that are still too large go on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.storage import stored

GROUP = 16
GROUPS = 8


def _hash_groups(df: DataFrame, key: str):
    own = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    whole = F.md5(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    for g in range(GROUPS):
        text = own if g < 4 else whole
        yield F.conv(F.substring(text, 4 * (g % 4) + 1, 4), 16, 10).cast("int")


def _leaves(sums: DataFrame, limit: int) -> DataFrame:
    """Directory of a group of bits: (parent, value, depth, bytes, fits) for every value.

    depth is the number of bits of the group that the value's bucket uses; fits is false
    where even all bits leave it over the limit.
    """
    # Bytes under every prefix of every length, then per value the shortest that fits.
    levels = F.explode(F.sequence(F.lit(0), F.lit(GROUP))).alias("depth")
    cut = F.expr(f"shiftright(value, {GROUP} - depth)").alias("prefix")
    spread = sums.select("parent", "value", "bytes", levels).withColumn("prefix", cut)
    totals = spread.groupBy("parent", "depth", "prefix").agg(F.sum("bytes").alias("bytes"))
    per_value = spread.select("parent", "value", "depth", "prefix").join(totals, ["parent", "depth", "prefix"])
    fitting = F.when(F.col("bytes") <= limit, F.struct("depth", "bytes"))
    last = F.max(F.when(F.col("depth") == GROUP, F.col("bytes")))
    found = per_value.groupBy("parent", "value").agg(F.min(fitting).alias("leaf"), last.alias("whole"))
    return found.select(
        "parent",
        "value",
        F.coalesce("leaf.depth", F.lit(GROUP)).alias("depth"),
        F.coalesce("leaf.bytes", "whole").alias("bytes"),
        F.col("leaf").isNotNull().alias("fits"),
    )


def assign_shards(df: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, shard, depth, row_bytes, shard_bytes, oversized) of every row.

    shard is the bucket's prefix of bits ('' if all rows fit in one), row_bytes the UTF-8
    length of the text (null: 0). Every shard holds at most `limit` bytes, unless all its rows
    are equal in every column or one row alone is larger: those cannot be split, stay whole
    and are marked oversized. Null keys hash like ''.
    """
    hashes = list(_hash_groups(df, key))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = df.select(F.col(key).alias("key"), size.alias("row_bytes"), *[h.alias(f"h{g}") for g, h in enumerate(hashes)])
    waiting, done = rows.withColumn("parent", F.lit("")), []
    for g in range(GROUPS):
        sums = waiting.groupBy("parent", F.col(f"h{g}").alias("value")).agg(F.sum("row_bytes").alias("bytes"))
        directory = stored(_leaves(sums, limit), "directory")
        bits = F.lpad(F.bin(F.col("value").cast("long")), GROUP, "0")
        named = directory.withColumn("b", bits).select(
            F.col("parent").alias("p"),
            "value",
            F.expr("concat(parent, substring(b, 1, depth))").alias("shard"),
            (F.lit(GROUP * g) + F.col("depth")).alias("depth"),
            F.col("bytes").alias("shard_bytes"),
            "fits",
        )
        joined = waiting.join(named, (F.col("parent") == F.col("p")) & (F.col(f"h{g}") == F.col("value"))).drop("p", "value", "parent")
        last = g == GROUPS - 1
        final = joined if last else joined.where("fits")
        done.append(final.select("key", "shard", "depth", "row_bytes", "shard_bytes", (~F.col("fits")).alias("oversized")))
        if last or directory.where("NOT fits").isEmpty():
            break
        waiting = joined.where("NOT fits").withColumnRenamed("shard", "parent").drop("depth", "shard_bytes", "fits")
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out.withColumnRenamed("key", key)
