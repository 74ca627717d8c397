"""The classifier against votes counted text by text, and the bound of its sample."""

import math
import random

import numpy as np
import pytest

from panelcast.llm import classifier as C


def plain_terms(text):
    """Term counts of one text as a dictionary."""
    raw, counts = (text or "").encode(), {}
    classes = C._byte_classes()[np.frombuffer(raw, np.uint8)].tolist()

    def add(term, n=1):
        counts[term] = counts.get(term, 0) + n

    for i in range(len(raw) - 3):
        a, b, c, d = classes[i : i + 4]
        add(((a * 8 + b) * 8 + c) * 8 + d)
        add(C.CLASS_GRAMS + (raw[i] * 7919 + raw[i + 1] * 104729 + raw[i + 2] * 1299709) % C.TRIGRAMS)
    words, at = raw.split(), 0
    while at < len(words):
        run = 1
        while at + run < len(words) and words[at + run] == words[at]:
            run += 1
        add(C.CLASS_GRAMS + C.TRIGRAMS + min(int(math.log2(run)), C.RUNS - 1), run)
        at += run
    return counts


def dense(texts):
    out = np.zeros((len(texts), C.TERMS))
    for row, text in zip(out, texts):
        for term, n in plain_terms(text).items():
            row[term] = n
    return out


def unit(rows):
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def plain_scores(train, labels, prior, texts):
    """With no more training texts than dimensions, the latent space is the span of their rows."""
    counts, labels = dense(train), np.array(labels)
    idf = np.log((1 + len(train)) / (1 + (counts > 0).sum(0))) + 1
    basis = np.linalg.svd(unit(np.log1p(counts) * idf), full_matrices=False)[2].T
    near = unit(unit(np.log1p(counts) * idf) @ basis)
    share = {0: (1 - prior) / max((labels == 0).sum(), 1), 1: prior / max((labels == 1).sum(), 1)}
    for text in texts:
        own = unit(unit(np.log1p(dense([text])) * idf) @ basis)[0]
        cosines = near @ own
        votes = {0: 0.0, 1: 0.0}
        for i in np.argsort(-cosines)[: C.NEIGHBOURS]:
            votes[labels[i]] += max(cosines[i], 1e-6) ** C.SHARPNESS * share[labels[i]]
        yield votes[1] / (votes[0] + votes[1])


@pytest.fixture(scope="module")
def prose():
    pick = random.Random(4)

    def good(n):
        return " ".join("".join(pick.choice("aeioulnrst") for _ in range(pick.randrange(2, 8))) for _ in range(n)).capitalize() + "."

    def bad(n):
        return " ".join(pick.choice(["BUY", "!!!", "$$$", "x9", "click click click", "#1"]) for _ in range(n))

    return [(good if i % 3 else bad)(pick.randrange(3, 40)) for i in range(90)]


def test_scores_are_the_votes_of_the_nearest(spark, prose):
    docs = spark.createDataFrame(list(enumerate(prose)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    model = C.fit(docs, labels)
    rows, prior = C.training_rows(docs, labels)
    used = sorted((r.doc_id, r.label, r.text) for r in rows.collect())
    assert 20 < len(used) <= C.DIMENSIONS
    want = list(plain_scores([u[2] for u in used], [u[1] for u in used], prior, prose))
    found = {r.doc_id: r.score for r in C.score(docs, model).collect()}
    near = [i for i in range(90) if abs(found[i] - want[i]) < 1e-3]
    # Equal cosines at the last place may be drawn differently.
    assert len(near) >= 88
    assert np.mean([(found[i] >= 0.5) == (i % 3 > 0) for i in range(60, 90)]) > 0.9


def test_the_sample_is_bounded_in_rows(spark):
    rows = [(6, f"text number {i} of one id") for i in range(2000)] + [(i, f"other text {i}") for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(6, 1)] + [(i, i % 2) for i in range(100, 160)], "doc_id long, quality int")
    assert 6 in {r.doc_id for r in docs.where(~C.is_held_out()).select("doc_id").distinct().collect()}
    for per_class in (10, 50):
        found, _ = C.training_rows(docs, labels, per_class)
        sizes = {r.label: r["count"] for r in found.groupBy("label").count().collect()}
        assert max(sizes.values()) <= per_class and set(sizes) == {0, 1}
        assert len(C.fit(docs, labels, per_class).labels) <= 2 * per_class
