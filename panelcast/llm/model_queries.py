"""Queries op11, op12 and op13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import language_id, structure_repair, whitening
from panelcast.llm.registry import query, table


@query()
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id",
        "component",
        "n",
        F.expr("try_cast(deviation AS long)").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
        F.col("deviation").alias("deviation_exact"),
    )


@query()
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where("doc_id IS NOT NULL").where(~language_id.is_held_out()))
    rows = docs.select("doc_id", "text", language_id.is_held_out().alias("held_out"))
    return language_id.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def _repair_sql() -> str:
    """A plain dynamic programme over the four states of the role automaton: e (nothing), s, u, a.
    Each state holds the least (cost, audit, text). Steps: 1 reads a row, 2 may insert a user's
    turn, 3 an assistant's."""

    def more(state: str, cost: str, edit: str, text: str = "acc.{}.t") -> str:
        return f"{{'c': acc.{state}.c + {cost}, 'a': acc.{state}.a || '{edit}', 't': {text.format(state)}}}"

    def added(state: str, cost: str, edit: str, role: str, body: str) -> str:
        return more(state, cost, edit, f"acc.{{}}.t || chr(10) || {role} || ':' || {body}")

    far = 1_000_000_000
    into = {"e": [], "s": ["e"], "u": ["e", "s", "a"], "a": ["u"]}
    roles = {"u": "'user'", "a": "'assistant'"}
    cells = []
    for to, sources in into.items():
        read = [more(to, "4", "D")]
        for source in sources:
            keep = f"CASE WHEN x.lost OR x.i <> '{to}' THEN {far} ELSE x.late END"
            read.append(added(source, keep, "K", "x.role", "x.text"))
            if to in roles:
                rerole = f"CASE WHEN x.lost THEN {far} ELSE 3 + x.late END"
                read.append(added(source, rerole, "R", roles[to], "x.text"))
        insert = [f"acc.{to}"] + [added(source, "3", "I", roles[to], "''") for source in sources if to in roles]
        step = {"u": 2, "a": 3}.get(to, 9)
        cells.append(
            f"'{to}': CASE x.step WHEN 1 THEN least({', '.join(read)}) "
            f"WHEN {step} THEN least({', '.join(insert)}) ELSE acc.{to} END"
        )
    start = ", ".join(f"'{k}': {{'c': {0 if k == 'e' else far}::BIGINT, 'a': '', 't': ''}}" for k in into)
    op = "{{'step': {}, 'lost': {}, 'late': {}, 'i': {}, 'role': {}, 'text': {}}}"
    inserts = [op.format(k, "false", "0", "''", "''", "''") for k in (2, 3)]
    row = op.format("1", "lost", "late", "initial", "role", "text")
    # CRC-32, bit by bit.
    fed = "(CASE WHEN i % 8 = 0 THEN xor(acc, ascii(key[i // 8 + 1])::BIGINT) ELSE acc END)"
    return rf"""
WITH keyed AS (
    SELECT *, xor(4294967295, list_reduce(
               range(0, 8 * length(key)), lambda acc, i: xor(({fed}) >> 1, ({fed} & 1) * 3988292384), 4294967295)) % 20 AS action
    FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations)),
damaged AS (
    SELECT conv_id, turn, CASE WHEN action = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
           CASE WHEN action = 1 THEN '' WHEN action = 2
                THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
           unnest(range(0, CASE action WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM keyed WHERE action <> 0),
placed AS (
    SELECT *, left(role, 1) AS initial, row_number() OVER w AS pos,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
           lag(left(role, 1)) OVER w || left(role, 1) AS pair,
           regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending
    FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
faults AS (
    SELECT *, ending = '' AS blank, again AND ending <> '' AS duplicate,
           ending <> '' AND NOT again AND ending NOT IN ('.', '!', '?') AS truncated FROM placed),
steps AS (
    SELECT *, blank OR duplicate AS lost, CASE WHEN truncated THEN 3 ELSE 0 END AS late FROM faults),
folded AS (
    SELECT conv_id,
           CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
           count(*) FILTER (truncated) AS truncated,
           count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
           list_reduce([{", ".join(inserts)}] || flatten(list([{row}, {", ".join(inserts)}] ORDER BY pos)),
                       lambda acc, x: {{{", ".join(cells)}}}, {{{start}}}) AS f
    FROM steps GROUP BY conv_id),
best AS (SELECT *, least(f.e, f.a) AS b FROM folded)
SELECT DISTINCT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit,
       sha256(coalesce(b.t[2:], '')) AS repaired_sha256
FROM conversations AS c LEFT JOIN best ON c.conv_id IS NOT DISTINCT FROM best.conv_id"""


REPAIR_SQL = _repair_sql()


@query(REPAIR_SQL)
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = structure_repair.damage(table(spark, sf_dir, "conversations"))
    return structure_repair.summarise(rows)
