"""Pipeline stages on tables with null and repeated ids, nulls, copies and near copies."""

from collections import Counter

import duckdb
import pytest
from test_odd_tables import brute_cut, repeated_ids

import corpus_pipeline
from panelcast.llm.text_queries import quality_sql

SF_DIR = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def rows(odd_rows):
    return odd_rows + [(i, t, "en", "s", None) for i, t in repeated_ids()]


@pytest.fixture(scope="module")
def table(spark, odd, rows):
    return spark.createDataFrame(rows, odd.schema).repartition(3)


def texts(found):
    return Counter((r[0], r[1]) for r in found)


def test_rules(spark, table, rows):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    want = connection.execute(f"WITH {quality_sql()} SELECT doc_id, text FROM judged WHERE kept").fetchall()
    found = texts(STAGE["quality_rules"](spark, table, SF_DIR).collect())
    assert found == texts(want) and any(i is None for i, _ in found)


def test_classifier_judges_by_text(spark, table, rows):
    found = texts(STAGE["quality_classifier"](spark, table, SF_DIR).collect())
    good = {t for _, t in found}
    assert good and found == texts(r for r in rows if r[1] in good)


def test_near_duplicates(spark, table, rows):
    """All but (4, 5) near 3, 7 equal to 6, the null id of 3 and near copies of other rows stay."""
    own = [t for _, t in repeated_ids()]
    want = [(i, t) for i, t, *_ in rows if i is not None and i < 14 and i not in (4, 5, 7)] + [(None, None)]
    want += [(50, own[0]), (50, own[1]), (50, own[2]), (40, own[6])]
    found = texts(STAGE["near_duplicates"](spark, table, SF_DIR).collect())
    unnamed = [x for x in found if x[0] is None and x[1] in (own[7], own[8])]
    assert len(unnamed) == 1
    assert found == texts(want + unnamed)


def test_repeated_passages(spark, table, rows):
    want = Counter()
    for (i, text, *_), (_, _, gone, kept) in zip(rows, brute_cut(rows), strict=True):
        want[(i, kept if gone else text)] += 1
    assert texts(STAGE["repeated_passages"](spark, table, SF_DIR).collect()) == want
