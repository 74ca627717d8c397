"""Left join to a table with unique keys that no heavy key can slow down."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_KEYS of all rows, so fewer than HOT_KEYS keys
# can be hot, whatever the size of the tables.
HOT_KEYS = 10_000
MIN_HOT_ROWS = 100_000
COPY = "__copy"


def _null_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` without rows whose key has a NULL; fails with the key where two rows share one.

    Equal keys are neighbours in a sorted partition, so each row looks at the one before. The shuffle
    and sort are those that a join on ``keys`` needs anyway, and a copied key goes no further
    than its neighbour's check. The check is a filter: it runs whatever columns are read.
    """
    order = Window.partitionBy(*keys).orderBy(*keys)
    texts = [F.col(k).cast("string") for k in keys]
    message = F.concat(F.lit("duplicate key: "), F.concat_ws(" ", *texts))
    again = F.col(COPY) > 1
    alone = F.when(again, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    rows = df.where(~_null_key(keys)).withColumn(COPY, F.row_number().over(order))
    return rows.where(alone).drop(COPY)


def lookup_unique(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot_keys: int = HOT_KEYS,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """``left`` with the columns of its ``right`` row; ``right`` has one row per key, which is
    checked on the way (:func:`unique_rows`): a repeated key fails the query.

    Rows of hot keys are not shuffled: the right rows of those keys, fewer than
    ``hot_keys`` by construction, go to them. Rows with a NULL in a key match nothing and
    are not shuffled either. All others take an ordinary shuffled join, in which no key
    has more than its small share. Without hot keys, adaptive execution drops that branch.
    """
    keys = list(keys)
    added = [c for c in right.columns if c not in keys]
    columns = [*left.columns, *added]
    null_key = _null_key(keys)
    right = unique_rows(right, keys)

    counts = left.where(~null_key).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    heavy = (F.col("rows") > min_hot_rows) & (F.col("rows") * hot_keys > total)
    hot = F.broadcast(counts.where(heavy).select(*keys))

    keyed = left.where(~null_key)
    few = F.broadcast(right.join(hot, keys, "left_semi"))
    of_hot = keyed.join(hot, keys, "left_semi").join(few, keys, "left")
    of_rest = keyed.join(hot, keys, "left_anti").join(right, keys, "left")
    types = {f.name: f.dataType for f in right.schema.fields}
    of_null = left.where(null_key).select(
        *left.columns, *[F.lit(None).cast(types[c]).alias(c) for c in added]
    )
    return of_rest.select(*columns).union(of_hot.select(*columns)).union(of_null)
