"""Language identification against a plain version, and its accuracy on held-out rows."""

import unicodedata
import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from panelcast.llm import language_id
from panelcast.llm.queries import QUERIES


def plain_vector(text):
    """Bundle of a text, trigram by trigram."""
    symbols = [c if unicodedata.category(c)[0] in "LM" else None for c in (text or "").lower()]
    symbols = [None, *symbols, None]
    out = np.zeros(language_id.DIMENSIONS)
    for i in range(1, len(symbols) - 1):
        if symbols[i] is None:
            continue
        vector = np.ones(language_id.DIMENSIONS)
        for place in range(3):
            code = ord(symbols[i - 1 + place] or "\0")
            bits = np.unpackbits(language_id.letter_bits(np.array([code])).view(np.uint8))
            vector *= np.roll(1 - 2.0 * bits, 64 * (2 - place))
        out += vector
    return out


def plain_cosine(a, b):
    return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))


def plain(train, texts):
    sums = {}
    for lang, text in train:
        if lang is not None and text is not None:
            sums[lang] = sums.get(lang, 0) + plain_vector(text)
    unit = {k: v / np.linalg.norm(v) for k, v in sums.items() if np.any(v)}
    shared = sum(unit.values()) / len(unit) if len(unit) > 1 else 0
    for text in texts:
        if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
            yield "und", 0.0
            continue
        own = plain_vector(text)
        scores = [(plain_cosine(own / np.linalg.norm(own) - shared, v - shared), k) for k, v in unit.items()]
        best = max(s for s, _ in scores)
        yield min(k for s, k in scores if s == best), min(max(best, 0.0), 1.0)


def test_equals_plain_version(spark):
    train = [("en", "the Thing that they thought"), ("de", "ÜBER die Straße, über"), ("fr", "ça été là"), ("fr", None), (None, "lost"), ("xx", "123"), ("hi", "हिन्दी भाषा")]
    texts = [None, "", "123 !?", "they thin", "die über", "été", "हिन्दी", "x", "The\nthe\tTHE", "́", "日本", "the " * 50_000]
    model = language_id.fit(spark.createDataFrame(train, "lang string, text string").withColumn("value", F.lit(1)))
    assert model.langs == ["de", "en", "fr", "hi"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit("own")).withColumn("lang", F.lit("x"))
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs.repartition(3), model).collect()}
    for i, (lang, score) in enumerate(plain(train, texts)):
        assert found[i][0] == lang and abs(found[i][1] - score) < 1e-5, texts[i][:20]


def test_long_texts_in_parts(spark, monkeypatch):
    text = "Zwölf Boxkämpfer jagen Viktor quer, über den Sylter Deich! " * 20
    want = plain_vector(text)
    import pyarrow as pa

    for size in (7, 64, 1 << 17):
        monkeypatch.setattr(language_id, "SYMBOLS", size)
        ((first, vectors, lettered),) = language_id.bundles(pa.array([text, "1"]))
        assert first == 0 and (vectors[0] == want).all() and lettered.tolist() == [True, False]


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    table = {r[0]: r[1] for r in duckdb.sql(f"SELECT doc_id, lang FROM '{sf_dir}/documents.parquet'").fetchall()}
    rows = QUERIES["op12_language_id"](spark, sf_dir).collect()
    assert len(rows) == len(table)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r.lang_pred == table[r.doc_id] for r in rows if r.held_out and table[r.doc_id]]
    assert sum(held) >= 0.98 * len(held)


def test_learns_from_its_rows_only(spark):
    rows = [(i, "the and that", "en", None, None) for i in range(30)] + [(i, "der und das", "de", None, None) for i in range(30, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = docs.where(~language_id.is_held_out())
    changed = docs.withColumn("lang", F.when(language_id.is_held_out(), "zz").otherwise(F.col("lang")))
    a, b = language_id.fit(kept), language_id.fit(changed.where(~language_id.is_held_out()))
    assert a.langs == b.langs == ["de", "en"] and (a.vectors == b.vectors).all()


def test_odd_tables(spark, odd, odd_rows, empty):
    model = language_id.fit(odd)
    assert language_id.predict(odd, model).count() == len(odd_rows)
    assert language_id.predict(empty, model).count() == 0
    unlearned = language_id.predict(odd, language_id.fit(empty)).collect()
    assert len(unlearned) == len(odd_rows) and {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)}
    one = language_id.fit(odd.where("lang = 'en'"))
    assert {r.lang_pred for r in language_id.predict(odd, one).collect()} == {"en", "und"}
