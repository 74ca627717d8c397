"""Row windows along each entity's days.

Two physical forms give the same rows:

* one window per entity. With a unique (entity, day) key a group cannot outgrow the
  calendar (a century is 36,525 rows), however large its share of the table is, so this
  is the default. The uniqueness is enforced while the window runs, at no extra shuffle.
  Rows without entity or day have no place on a timeline and stay out of it.
* ``chunk_days``: windows per (entity, chunk of days), so that a few long series spread
  over many tasks. The rows that frames reach over a chunk's borders, its halo, are copied into
  the chunk before the one shuffle of the window, and their copies are dropped after it. How
  many calendar days a halo spans depends on the gaps in the series; it is found from the
  outermost days of each chunk, a table of a few days per chunk. No window group is larger
  than its chunk and ``lookback + lookahead`` rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

CHUNK, SOURCE = "__chunk", "__source"
BEFORE = "__day_before"
FROM, UPTO = "__from", "__upto"

WindowColumns = Callable[[WindowSpec], dict[str, Column]]


def _is_unique(entity: str, day: str) -> Column:
    """True; fails the query when the previous row has the same day."""
    message = F.concat(
        F.lit("duplicate key: "),
        F.coalesce(F.col(entity).cast("string"), F.lit("NULL")),
        F.lit(" "),
        F.col(day).cast("string"),
    )
    repeated = F.col(BEFORE) == F.col(day)
    return F.when(repeated, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def _computed(df: DataFrame, keep: list[str], key: tuple[str, str], window: WindowSpec, build):
    """``keep`` and the built columns. The check is a filter, as one on a column would vanish
    from queries that do not read that column."""
    entity, day = key
    columns = {BEFORE: F.lag(day, 1).over(window)} | build(window)
    rows = df.select(*keep, *[c.alias(n) for n, c in columns.items()])
    return rows.where(_is_unique(entity, day)).drop(BEFORE)


def along_days(
    panel: DataFrame,
    entity: str,
    day: str,
    build: WindowColumns,
    lookback: int,
    lookahead: int,
    chunk_days: int | None = None,
) -> DataFrame:
    """Append the columns that ``build`` makes from a window ordered by day.

    ``lookback`` and ``lookahead`` say how many rows before and after the current one the
    columns read. All columns share one window, hence one shuffle and one sort.
    """
    key, keep = (entity, day), panel.columns
    panel = panel.where(F.col(entity).isNotNull() & F.col(day).isNotNull())
    by_entity = Window.partitionBy(entity).orderBy(day)
    if chunk_days is None:
        return _computed(panel, keep, key, by_entity, build)

    number = F.floor(F.unix_date(day) / chunk_days)
    placed = panel.withColumn(SOURCE, number)
    halos = _halos(placed, entity, day, chunk_days, lookback, lookahead)
    ordinal, source, target = F.unix_date(day), F.col(SOURCE), F.col(CHUNK)
    wanted = (source == target) | F.when(source < target, ordinal >= F.col(FROM)).otherwise(ordinal <= F.col(UPTO))
    copied = placed.join(halos, [entity, SOURCE]).where(wanted).select(*keep, SOURCE, CHUNK)
    by_chunk = Window.partitionBy(entity, CHUNK).orderBy(day)
    made = _computed(copied, [*keep, SOURCE, CHUNK], key, by_chunk, build)
    return made.where(F.col(SOURCE) == F.col(CHUNK)).drop(SOURCE, CHUNK)


def _halos(placed: DataFrame, entity: str, day: str, chunk_days: int, lookback: int, lookahead: int) -> DataFrame:
    """(entity, source, chunk, from, upto): the chunks whose windows need rows of a source chunk, and
    the first and last day (as numbers) that they need.

    The last ``lookback`` rows before a chunk lie in at most as many chunks that have rows, and
    likewise after it, so neighbours in an entity's list of chunks suffice. The list holds a few
    days per chunk and is bounded by the calendar.
    """
    outer = placed.groupBy(entity, SOURCE).agg(F.sort_array(F.collect_list(F.unix_date(day))).alias("days"))
    outer = outer.select(
        entity,
        F.struct(
            F.col(SOURCE).alias("chunk"),
            F.slice("days", 1, lookahead).alias("first"),
            F.slice("days", F.greatest(F.size("days") - lookback, F.lit(0)) + 1, lookback).alias("last"),
        ).alias("part"),
    )
    listed = outer.groupBy(entity).agg(F.sort_array(F.collect_list("part")).alias("parts"))
    before = f"flatten(transform(slice(parts, greatest(i - {lookback}, 0) + 1, least(i, {lookback})), y -> y.last))"
    after = f"flatten(transform(slice(parts, i + 2, {lookahead}), y -> y.first))"
    spans = listed.select(
        entity,
        F.expr(f"inline(transform(parts, (x, i) -> struct(x.chunk AS {CHUNK}, {before} AS before, {after} AS after)))"),
    )
    spans = spans.select(
        entity,
        CHUNK,
        F.expr(f"get(before, greatest(size(before) - {lookback}, 0))").alias(FROM),
        F.expr(f"get(after, least(size(after), {lookahead}) - 1)").alias(UPTO),
    )
    first, last = (F.coalesce(F.floor(F.col(c) / chunk_days), F.col(CHUNK)) for c in (FROM, UPTO))
    return spans.withColumn(SOURCE, F.explode(F.sequence(first, last)))
