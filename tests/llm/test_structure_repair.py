"""Repair of conversations against exhaustive search, and on odd tables. The query itself is
compared with its SQL in test_queries_llm."""

import hashlib
import itertools
import random
import re

from pyspark.sql import functions as F

from panelcast.llm import structure_repair as R

GRAMMAR = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, copies long"


def cheapest(turns):
    """Least (cost, audit) over all edits of short `turns` with few inserts."""
    options = []
    for initial, kind, _ in turns:
        own = [(4, "D", "")]
        if kind not in ("blank", "duplicate"):
            late = 3 * (kind == "truncated")
            own += [(late, "K", initial or "?"), (3 + late, "R", "u"), (3 + late, "R", "a")]
        options.append(own)
    inserts = [list(itertools.chain(*(itertools.product("ua", repeat=n) for n in range(3))))] * (len(turns) + 1)
    best = None
    for edits in itertools.product(*options):
        base = sum(e[0] for e in edits)
        for added in itertools.product(*inserts):
            cost = base + 3 * sum(map(len, added))
            if best is not None and cost > best[0]:
                continue
            audit, roles = "I" * len(added[0]), "".join(added[0])
            for edit, more in zip(edits, added[1:]):
                audit, roles = audit + edit[1] + "I" * len(more), roles + edit[2] + "".join(more)
            if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def parsed(turns):
    ends = R.parse(turns, {R.FIRST: (0, "")})
    return min(v for link, v in ends.items() if link[0] in R.ACCEPTED)


def test_parser_against_exhaustive_search():
    pick = random.Random(11)
    for _ in range(400):
        turns = [(pick.choice(["s", "u", "a", "t", ""]), pick.choice([None, None, "blank", "duplicate", "truncated"]), 1) for _ in range(pick.randrange(4))]
        assert parsed(turns) == cheapest(turns), turns


def test_copies_are_duplicates():
    pick = random.Random(3)
    for _ in range(200):
        turns = [(pick.choice("suat"), pick.choice([None, "blank", "truncated"]), pick.randrange(1, 4)) for _ in range(pick.randrange(5))]
        apart = [(i, k if n == 0 or k == "blank" else "duplicate", 1) for i, k, copies in turns for n in range(copies)]
        assert parsed(turns) == parsed(apart)


def test_chained_chunks_equal_one_parse():
    pick = random.Random(5)
    turns = [(pick.choice("suat"), pick.choice([None, None, "blank", "truncated"]), 1) for _ in range(60)]
    frontier = {R.FIRST: (0, "")}
    for at in range(0, 60, 7):
        after = {}
        for start, (cost, audit) in frontier.items():
            for end, (more, edits) in R.parse(turns[at : at + 7], {start: (0, "")}).items():
                R._put(after, end, (cost + more, audit + edits))
        frontier = after
    assert min(v for link, v in frontier.items() if link[0] in R.ACCEPTED) == parsed(turns)


def rows_of(df, limit):
    return sorted(map(tuple, R.summarise(df, limit).collect()), key=repr)


def test_long_conversations(spark):
    pick = random.Random(8)
    texts = ["Yes.", "No!", "cut", "", " \t", "Why?", "é日."]
    rows = [(1, k // 3, pick.choice(["user", "assistant", "system", "tool"]), f"{pick.choice(texts)}" + str(k) * (k % 2) + ".", 1) for k in range(400)]
    rows += [(2, pick.randrange(40), pick.choice(["user", "assistant"]), pick.choice(texts), pick.randrange(3)) for _ in range(300)]
    rows += [(None, None, "user", "Hi.", 1), (None, 3, "assistant", "Yes.", 5), (3, 1, "user", "Gone.", 0), (4, 1, "user", "Hi.", 200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    whole = rows_of(df, 1 << 40)
    assert len(whole) == 5
    for limit in (0, 3, 150):
        assert rows_of(df, limit) == whole


def test_long_conversations_in_many_chunks(spark, monkeypatch):
    """Chunks of a few rows give the same repair."""
    rows = [(1, k, ("user", "assistant")[k % 3 == 0], f"Text {k % 50}" + "." * (k % 4 > 0), 1 + (k % 7 == 0)) for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = rows_of(df, 1 << 40)
    monkeypatch.setattr(R, "CHUNK_BITS", 2)
    assert rows_of(df, 10) == whole
    pieces = R.repair(df, 10).orderBy("piece").collect()
    assert len(pieces) > 20 and not any(p.whole for p in pieces)
    text = "\n".join(p.text for p in pieces if p.n_turns)
    assert hashlib.sha256(text.encode()).hexdigest() == whole[0][-1]


def test_odd_rows(spark):
    rows = [(1, None, None, None, 1), (1, 5, "", "x.", 1), (2, 0, "user", "Hi.", 1), (2, 0, "user", "Hi.", 1), (2, 1, "assistant", "Yes.\x0b", 1), (3, 1, "user", "gone", 0)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit("own").alias(c) for c in ("piece", "audit", "n", "at", "again")))
    found = {r.conv_id: r for r in R.summarise(df).collect()}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert (found[1].blank, found[1].cost, found[1].audit, found[1].gaps) == (1, 8, "DD", 0)
    assert (found[2].duplicate, found[2].audit, found[2].repaired_sha256) == (1, "KDK", digest("user:Hi.\nassistant:Yes.\x0b"))
    assert (found[3].cost, found[3].audit, found[3].gaps, found[3].repaired_sha256) == (0, "", 0, digest(""))
    assert R.summarise(df.where("false")).count() == 0
    assert R.repair(df.where("false")).count() == 0


def test_damage_of_nulls(spark):
    df = spark.createDataFrame([(None, None, None, None), (None, 2, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    found = R.damage(df.withColumn("copies", F.lit("own"))).collect()
    assert len(found) == 2 and all(r.text is not None and r.role is not None for r in found)


def test_very_long_text(spark):
    text = "word " * 400_000 + "."
    df = spark.createDataFrame([(1, 0, "user", text, 1), (1, 1, "assistant", text, 1)], SCHEMA)
    for limit in (0, 100):
        (row,) = R.summarise(df, limit).collect()
        assert row.audit == "KK" and row.repaired_sha256 == hashlib.sha256(f"user:{text}\nassistant:{text}".encode()).hexdigest()
