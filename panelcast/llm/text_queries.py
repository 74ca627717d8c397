"""Queries op5, op8, op9, op10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import classifier
from panelcast.llm.near_dedup import near_duplicates
from panelcast.llm.quality_rules import (
    MAX_REPEAT_PCT,
    MEASURES,
    MIN_GROUP,
    MIN_WORDS,
    SPREADS,
    WINDOW,
    quality_rules,
)
from panelcast.llm.registry import query, table
from panelcast.llm.substring_dedup import WINDOW as LONG_WINDOW
from panelcast.llm.substring_dedup import dedup_substrings


def quality_sql(documents: str = "documents") -> str:
    """CTEs ending in `judged`: every row of `documents` with its counts and verdict."""
    values = [f"{top} * 1000 // greatest({below}, 1) AS v_{m}" for m, (top, below, _, _) in MEASURES.items()]
    cells = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS m, v_{m} AS v FROM valued WHERE NOT base_failed" for m in MEASURES
    )
    passes = []
    for m, (_, _, least, both) in MEASURES.items():
        spread = f"{SPREADS} * greatest(q3_{m} - q1_{m}, {least})"
        passes.append(f"v_{m} <= q3_{m} + {spread}")
        if both:
            passes.append(f"v_{m} >= q1_{m} - {spread}")
    wide = ", ".join(f"max(q1) FILTER (m = '{m}') AS q1_{m}, max(q3) FILTER (m = '{m}') AS q3_{m}" for m in MEASURES)
    return rf"""
    numbered AS (
        SELECT row_number() OVER () AS rid, *,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM {documents}),
    windows AS (
        SELECT rid, unnest(range(1, len(words) - {WINDOW - 2})) AS i, words FROM numbered
        WHERE len(words) >= {WINDOW}),
    spelt AS (SELECT rid, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w FROM windows),
    again AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS times FROM spelt),
    repeated AS (
        SELECT rid, count(DISTINCT i + k) AS n_repeat_words
        FROM again, range(0, {WINDOW}) AS t(k) WHERE times > 1 GROUP BY rid),
    lines AS (
        SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
        FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM numbered)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
    counted AS (
        SELECT n.* EXCLUDE (words), len(words) AS n_words,
               length(array_to_string(words, '')) AS word_chars,
               length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM numbered AS n LEFT JOIN lines USING (rid) LEFT JOIN repeated USING (rid)),
    valued AS (
        SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
               {", ".join(values)}
        FROM counted),
    cells AS ({cells}),
    bucketed AS (
        SELECT *, greatest(length(bin(v)) - 6, 0) AS low FROM cells),
    grouped AS (
        SELECT 0 AS level, lang, source, m, (v >> low) << low AS bucket FROM bucketed
        UNION ALL SELECT 1, lang, NULL, m, (v >> low) << low FROM bucketed),
    histogram AS (SELECT level, lang, source, m, bucket, count(*) AS n FROM grouped GROUP BY ALL),
    running AS (
        SELECT *, sum(n) OVER (PARTITION BY level, lang, source, m ORDER BY bucket) AS upto,
               sum(n) OVER (PARTITION BY level, lang, source, m) AS total
        FROM histogram),
    quartiles AS (
        SELECT level, lang, source, m, max(total) AS total,
               min(bucket) FILTER (4 * upto >= total) AS q1, min(bucket) FILTER (4 * upto >= 3 * total) AS q3
        FROM running GROUP BY ALL),
    wide AS (SELECT level, lang, source, max(total) AS total, {wide} FROM quartiles GROUP BY ALL),
    chosen AS (
        SELECT g.lang, g.source, l.* EXCLUDE (level, lang, source, total)
        FROM wide AS g JOIN wide AS l
          ON g.level = 0 AND g.lang IS NOT DISTINCT FROM l.lang
         AND CASE WHEN g.total >= {MIN_GROUP}
                  THEN l.level = 0 AND g.source IS NOT DISTINCT FROM l.source ELSE l.level = 1 END),
    judged AS (
        SELECT v.*, coalesce(NOT base_failed AND {" AND ".join(passes)}, false) AS kept
        FROM valued AS v LEFT JOIN chosen AS c
          ON v.lang IS NOT DISTINCT FROM c.lang AND v.source IS NOT DISTINCT FROM c.source)"""


COLUMNS = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept"


@query(f"WITH {quality_sql()} SELECT {COLUMNS} FROM judged")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(*COLUMNS.split(", "))


@query()
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = classifier.fit(docs, labels)
    rows = docs.select("doc_id", "text", classifier.is_held_out().alias("held_out"))
    return classifier.score(rows, model).select("doc_id", "held_out", "score", "predicted")


def substring_sql(documents: str = "documents") -> str:
    """CTEs ending in `cut`: every row of `documents` with its words and the kept ones."""
    return rf"""
    worded AS (
        SELECT row_number() OVER () AS rid, *,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM {documents}),
    long_windows AS (
        SELECT rid, doc_id, i, md5(array_to_string(words[i:i + {LONG_WINDOW - 1}], ' ')) AS w
        FROM (SELECT *, unnest(range(1, len(words) - {LONG_WINDOW - 2})) AS i FROM worded
              WHERE len(words) >= {LONG_WINDOW})),
    earliest AS (SELECT w, min(doc_id) AS least FROM long_windows GROUP BY w),
    covered AS (
        SELECT DISTINCT rid, i + k AS i
        FROM long_windows JOIN earliest USING (w), range(0, {LONG_WINDOW}) AS t(k)
        WHERE least < doc_id),
    places AS (SELECT rid, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM worded),
    left_over AS (
        SELECT rid, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS kept_text
        FROM places ANTI JOIN covered USING (rid, i) GROUP BY rid),
    cut AS (
        SELECT w.* EXCLUDE (words), len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed,
               coalesce(kept_text, '') AS kept_text
        FROM worded AS w LEFT JOIN left_over USING (rid))"""


@query(f"WITH {substring_sql()} SELECT doc_id, n_words, n_removed, sha256(kept_text) AS kept_sha256 FROM cut")
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")
