"""Quality rules with thresholds learnt per language and source.

Counts of a text come from one scan. Of each measure a histogram with log-linear buckets
(64 exact values, then 32 buckets per power of two) is kept per language and source. Such
histograms merge by adding counts, whatever the order, so they are built with map-side
combining and merged upwards: a group of fewer than `MIN_GROUP` texts uses the merged
histogram of its language. Quartiles of the histograms give the limits, and the limits are
joined to the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.arrays import find_words, text_blocks, window_starts
from panelcast.llm.columns import unused
from panelcast.llm.memory import returning
from panelcast.llm.storage import stored

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
MIN_GROUP = 50
SPREADS = 3
SYMBOLS = b"#*$%&|<>"
#: Measures (thousandths) and the least spread that counts as a spread. Limits are
#: upper quartile + SPREADS * max(quartile distance, least spread), and likewise below for
#: measures that can be too low.
MEASURES = {
    "symbols_per_word": ("n_symbols", "n_words", 40, False),
    "dup_lines_per_line": ("n_dup_lines", "n_lines", 150, False),
    "chars_per_word": ("word_chars", "n_words", 1000, True),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _named(pairs: np.ndarray) -> np.ndarray:
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


def _repeat_words(names: np.ndarray, word_offsets: np.ndarray) -> np.ndarray:
    """Per text, its words in windows found twice or more. `names` number the words exactly;
    pairs of numbers are numbered again, so equal numbers mean equal windows."""
    starts, text = window_starts(word_offsets, WINDOW)
    if not len(starts):
        return np.zeros(len(word_offsets) - 1, np.int64)
    width = 1
    while width < WINDOW:
        names = _named(names[:-width] * (names.max() + 1) + names[width:])
        width *= 2
    _, at, times = np.unique(
        text * (names.max() + 1) + names[starts], return_inverse=True, return_counts=True
    )
    marks = np.zeros(word_offsets[-1] + 1, np.int64)
    marks[starts[times[at] > 1]] = 1
    within = np.cumsum(marks)
    within[WINDOW:] -= within[:-WINDOW].copy()
    covered = np.concatenate([[0], np.cumsum(within[:-1] > 0)])
    return covered[word_offsets[1:]] - covered[word_offsets[:-1]]


def _counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    starts, ends, word_offsets = find_words(data, offsets)
    raw = data.tobytes()
    numbers: dict[bytes, int] = {}
    names = np.fromiter(
        (
            numbers.setdefault(raw[a:b], len(numbers))
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
        ),
        np.int64,
        len(starts),
    )
    table = np.zeros((4, 256), np.int64)
    table[0] = (np.arange(256) & 0xC0) != 0x80
    table[0][[9, 10, 11, 12, 13, 32]] = 0
    table[1][list(SYMBOLS)] = 1
    sums = [np.concatenate([[0], np.cumsum(row[data])]) for row in table[:2]]
    chars, symbols = (s[offsets[1:]] - s[offsets[:-1]] for s in sums)
    lines = np.zeros((len(offsets) - 1, 2), np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        own = [line for line in raw[a:b].split(b"\n") if line.strip()]
        lines[i] = len(own), len(own) - len(set(own))
    repeats = _repeat_words(names, word_offsets)
    return np.stack([np.diff(word_offsets), chars, symbols, lines[:, 0], lines[:, 1], repeats])


def _counter(text: str, keep: list[str]):
    def run(batches):
        for batch in batches:
            parts = [_counts(data, at) for _, _, data, at in text_blocks(batch.column(text))]
            values = np.concatenate([np.zeros((len(COUNTS), 0), np.int64), *parts], axis=1)
            columns = [batch.column(n) for n in keep] + [pa.array(row) for row in values]
            yield pa.RecordBatch.from_arrays(columns, keep + COUNTS)

    return run


def base_counts(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns (default: doc_id) and the counts of each whole text; null is empty.
    Columns of `df` named like a count are not kept."""
    keep = [c for c in (keep or ["doc_id"]) if c not in COUNTS]
    rows = df.select(*dict.fromkeys([*keep, text]))
    schema = T.StructType([rows.schema[c] for c in keep])
    for name in COUNTS:
        schema = schema.add(name, "long")
    return rows.mapInArrow(returning(_counter(text, keep)), schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")
    )


def _value(measure: str) -> Column:
    top, below, _, _ = MEASURES[measure]
    return F.expr(f"{top} * 1000 div greatest({below}, 1)")


def _bucket(value: Column) -> Column:
    """Values under 64 as they are, larger ones cut to their six leading bits."""
    low = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def limits(counts: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Limits per language and source, from the texts that pass the fixed base rules."""
    pairs = F.array(
        *(F.struct(F.lit(m).alias("m"), _bucket(_value(m)).alias("bucket")) for m in MEASURES)
    )
    cells = (
        counts.where(~base_failed())
        .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(pairs).alias("p"))
        .groupBy("lang", "source", "p.m", "p.bucket")
        .agg(F.count("*").alias("n"))
    )
    # One histogram per group and, merged from those, one per language (level 1).
    levels = F.array(
        F.struct(F.lit(0).alias("level"), F.col("lang"), F.col("source")),
        F.struct(F.lit(1).alias("level"), F.col("lang"), F.lit(None).cast("string").alias("source")),
    )
    merged = (
        cells.select(F.explode(levels).alias("g"), "m", "bucket", "n")
        .groupBy("g", "m", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("g", "m")
        .agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("h"))
    )
    # The buckets of a histogram are bounded (32 per power of two), so this is a short array.
    running = F.aggregate(
        "h",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q3")),
        lambda a, x: F.struct(
            (a.n + x.n).alias("n"),
            F.coalesce(a.q1, F.when(4 * (a.n + x.n) >= F.col("total"), x.bucket)).alias("q1"),
            F.coalesce(a.q3, F.when(4 * (a.n + x.n) >= 3 * F.col("total"), x.bucket)).alias("q3"),
        ),
    )
    quartiles = merged.withColumn("q", running)
    wide = quartiles.groupBy("g.level", "g.lang", "g.source").agg(
        F.max("total").alias("total"),
        *(
            F.max(F.when(F.col("m") == m, F.col(f"q.{q}"))).alias(f"{m}_{q}")
            for m in MEASURES
            for q in ("q1", "q3")
        ),
    )
    bounds = []
    for m, (_, _, least, both) in MEASURES.items():
        spread = SPREADS * F.greatest(F.col(f"{m}_q3") - F.col(f"{m}_q1"), F.lit(least))
        bounds.append((F.col(f"{m}_q3") + spread).alias(f"{m}_max"))
        if both:
            bounds.append((F.col(f"{m}_q1") - spread).alias(f"{m}_min"))
    return wide.select("level", "lang", "source", "total", F.struct(*bounds).alias("limits"))


def judged(counts: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """`counts` with base_failed and kept.

    Null languages and sources are groups of their own. A text is kept if it passes the base
    rules and every limit; limits hold themselves, so a group of equal texts is kept.
    """
    own_lang, own_source, own = unused(counts, "_lang", "_source", "_limits")
    found = limits(counts, lang, source)
    of_language = found.where("level = 1").select(F.col("lang").alias("l"), F.col("limits").alias("of_language"))
    chosen = (
        found.where("level = 0")
        .join(of_language, F.col("lang").eqNullSafe(F.col("l")), "left")
        .select(
            F.col("lang").alias(own_lang),
            F.col("source").alias(own_source),
            F.when(F.col("total") >= MIN_GROUP, F.col("limits")).otherwise(F.col("of_language")).alias(own),
        )
    )
    same = F.col(lang).eqNullSafe(F.col(own_lang)) & F.col(source).eqNullSafe(F.col(own_source))
    passes = ~base_failed()
    for m, (_, _, _, both) in MEASURES.items():
        passes &= _value(m) <= F.col(f"{own}.{m}_max")
        if both:
            passes &= _value(m) >= F.col(f"{own}.{m}_min")
    # Without limits every text of the group failed the base rules.
    return (
        counts.join(chosen, same, "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", F.coalesce(passes, F.lit(False)))
        .drop(own_lang, own_source, own)
    )


def quality_rules(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Counts and verdict of every row of `df` (columns lang and source), with `keep` columns
    (default: doc_id). Empty and null texts have no words and fail; an empty table gives none.
    Repeated rows are judged one by one. The counts are written once, as both the limits and
    the verdicts need them."""
    keep = keep or ["doc_id"]
    extra = [c for c in ("lang", "source") if c not in keep]
    counts = stored(base_counts(df, text, keep + extra), "quality")
    return judged(counts).drop(*extra)
