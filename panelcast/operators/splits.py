"""Exact search for the best single split of a table, as a tree makes it at its root.

Every feature's values are counted once, in one pass that combines before the shuffle; what
is sorted afterwards are distinct values, not rows. Binned features (:func:`equal_width_bins`) keep
them few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def equal_width_bins(
    df: DataFrame, columns: Sequence[str], bins: int, reference: DataFrame | None = None
) -> DataFrame:
    """`columns` replaced by the number (0 to bins - 1) of their equal-width bin between the least and
    largest value in `reference` (by default `df` itself). Values beyond go to the outer bins,
    a constant column has one bin, nulls and NaN become null."""
    source = df if reference is None else reference

    def real(c: str) -> Column:
        return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))

    row = source.agg(
        *[F.min(real(c)).alias(f"least_{i}") for i, c in enumerate(columns)],
        *[F.max(real(c)).alias(f"most_{i}") for i, c in enumerate(columns)],
    ).first()

    def bin_of(i: int, c: str) -> Column:
        least, most = row[f"least_{i}"], row[f"most_{i}"]
        if least is None:
            return F.lit(None).cast("double")
        if least == most:
            return F.when(real(c).isNotNull(), F.lit(0.0))
        share = (real(c) - F.lit(least)) / F.lit(most - least) * bins
        return F.greatest(F.lit(0.0), F.least(F.lit(bins - 1.0), F.floor(share).cast("double")))

    return df.withColumns(
        {c: F.when(real(c).isNotNull(), bin_of(i, c)) for i, c in enumerate(columns)}
    )


def candidate_cuts(
    df: DataFrame, features: Sequence[str], label: str, weight: str | None = None, least_rows: int = 1
) -> DataFrame:
    """Every cut between neighbouring values of every feature, with its gain.

    Columns: slot and feature, the values `below` and `above` the cut, `cut` half way between them,
    rows and mean label on both sides, and `gain`: the share of the label's weighted sum of squared
    deviations that the cut removes. For a 0/1 label that is also the share of Gini impurity it removes.
    A row goes left if its value is at most `cut`. Rows without label or weight are left out, for one feature also
    those without its value; cuts that leave fewer than `least_rows` rows on a side are no candidates.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    lines = [
        F.struct(F.lit(i).alias("slot"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for i, c in enumerate(features)
    ]
    cells = df.select(F.col(label).cast("double").alias("y"), w.alias("w"), F.inline(F.array(*lines)))
    cells = cells.where("y IS NOT NULL AND w IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)")
    counted = cells.groupBy("slot", "feature", "value").agg(
        F.count("*").alias("n"),
        F.sum("w").alias("w"),
        F.sum(F.col("w") * F.col("y")).alias("wy"),
        F.sum(F.col("w") * F.col("y") * F.col("y")).alias("wyy"),
    )
    order = Window.partitionBy("slot", "feature").orderBy("value")
    below = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = ("n", "w", "wy", "wyy")
    running = counted.select(
        "slot",
        "feature",
        F.col("value").alias("below"),
        F.lead("value").over(order).alias("above"),
        *[F.sum(c).over(below).alias(f"{c}_left") for c in sums],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in sums],
    ).where("above IS NOT NULL")
    running = running.withColumns({f"{c}_right": F.col(f"{c}_all") - F.col(f"{c}_left") for c in sums})

    def squares(side: str) -> Column:
        total = F.col(f"wy_{side}")
        return F.col(f"wyy_{side}") - F.try_divide(total * total, F.col(f"w_{side}"))

    gain = 1 - F.try_divide(squares("left") + squares("right"), squares("all"))
    enough = (F.col("n_left") >= least_rows) & (F.col("n_right") >= least_rows)
    return running.where(enough).select(
        "slot",
        "feature",
        "below",
        "above",
        ((F.col("below") + F.col("above")) / 2).alias("cut"),
        F.col("n_left").alias("left_rows"),
        F.col("n_right").alias("right_rows"),
        F.try_divide(F.col("wy_left"), F.col("w_left")).alias("left_mean"),
        F.try_divide(F.col("wy_right"), F.col("w_right")).alias("right_mean"),
        gain.alias("gain"),
    )


def best_split(
    df: DataFrame, features: Sequence[str], label: str, weight: str | None = None, least_rows: int = 1
) -> DataFrame:
    """The candidate cut of the largest gain; ties to the first feature, then the least cut. No row where
    no feature has two values or the label is constant."""
    cuts = candidate_cuts(df, features, label, weight, least_rows).where(F.col("gain").isNotNull())
    return cuts.orderBy(F.desc("gain"), "slot", "cut").limit(1)
