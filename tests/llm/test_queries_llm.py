"""Every query of the package against its SQL, or a brute-force version on a small table."""

import base64
import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from compare import differences, duck
from tokenizers import Tokenizer

import corpus_pipeline
from panelcast.llm import packing, warc
from panelcast.llm.queries import ORACLES, QUERIES
from panelcast.llm.record_queries import tokenizer_file

SF_DIR = "/root/testdata/sf0.001"


def rows_of(name):
    return duckdb.sql(f"SELECT * FROM '{SF_DIR}/{name}.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert differences(spark, duck(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR) == []


def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op1(spark):
    texts = {r[0]: r[1] or "" for r in rows_of("documents")}
    enc = encoding()
    found = QUERIES["op1_bpe_round_trip"](spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = enc.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def whole_ids(text):
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check_packed(found, texts):
    """Pieces cover each document's ids, sequences are gapless and few."""
    pieces, sequences = {}, {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, text in texts.items():
        ids = np.array(whole_ids(text), "<u4").tobytes()
        own = sorted(pieces.pop(doc), key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in own] == [
            (k, at // 4, len(ids[at : at + 8192]) // 4, zlib.crc32(ids[at : at + 8192]))
            for k, at in enumerate(range(0, len(ids), 8192))
        ]
    assert not pieces
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    total = sum(r.length for r in found)
    assert len(sequences) <= 1.02 * total / packing.LENGTH + 2


def test_op3(spark):
    texts = {r[0]: r[1] for r in rows_of("documents")}
    check_packed(QUERIES["op3_best_fit_packing"](spark, SF_DIR).collect(), texts)


def test_op7(spark):
    pages = {r[0]: (r[2] or "").encode() for r in rows_of("pages")}
    largest = {}
    for page, payload in pages.items():
        largest[payload] = max(page, largest.get(payload, page))
    found = {r.page_id: r for r in QUERIES["op7_warc_archives"](spark, SF_DIR).collect()}
    assert set(found) == set(pages)
    for page, payload in pages.items():
        r, first = found[page], largest[payload] == page
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r.record_type == ("response" if first else "revisit")
        assert r.refers_to == (None if first else largest[payload])


def shingles(text):
    words = (text or "").encode().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_op8(spark):
    """Pairs well over 0.8 share a class; classes hold nothing far below it."""
    texts = {r[0]: r[1] for r in rows_of("documents")}
    sets = {i: shingles(t) for i, t in texts.items()}
    classes = {r.doc_id: r.class_id for r in QUERIES["op8_minhash_near_dedup"](spark, SF_DIR).collect()}
    assert set(classes) == set(texts)
    best = dict.fromkeys(texts, 0.0)
    for i in texts:
        for j in texts:
            if i < j and sets[i] and sets[j]:
                similarity = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
                if similarity >= 0.85:
                    assert classes[i] == classes[j]
                if classes[i] == classes[j]:
                    best[i], best[j] = max(best[i], similarity), max(best[j], similarity)
    for i in texts:
        members = [j for j in texts if classes[j] == classes[i]]
        assert classes[i] == min(members)
        assert len(members) == 1 or best[i] > 0.7


def test_op9(spark):
    labels = {r[0]: r[1] for r in rows_of("labels")}
    found = QUERIES["op9_quality_classifier"](spark, SF_DIR).collect()
    assert len(found) == len(rows_of("documents"))
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_pipeline(spark):
    """Stage by stage against plain versions of their rules."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == corpus_pipeline.COLUMNS
        after = docs.collect()
        ids = {r.doc_id for r in after}
        assert ids <= {r.doc_id for r in before} and len(ids) == len(after)
        if name == "quality_rules":
            connection = duck(SF_DIR)
            kept = connection.execute(ORACLES["op5_quality_rules"].replace("SELECT doc_id, n_words", "SELECT doc_id AS d, n_words")).fetchall()
            assert ids == {r[0] for r in kept if r[-1]}
        if name == "repeated_passages":
            windows = set()
            for r in sorted(before, key=lambda r: r.doc_id):
                words = r.text.encode().split()
                own = [tuple(words[i : i + 50]) for i in range(len(words) - 49)]
                gone = {i + k for i, w in enumerate(own) if w in windows for k in range(50)}
                kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
                found = next(x for x in after if x.doc_id == r.doc_id)
                assert found.text == (kept if gone else r.text) and found.n_chars == len(found.text)
                windows.update(own)
        before = after
    check_packed(corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect(), {r.doc_id: r.text for r in before})


def test_chunks_are_whole_records(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/ b\r\n", "é" * 100_000), (2, None, "é" * 100_000), (3, "u", None), (None, "u", "x"), (4, "u", "x"), (4, "u", "x")],
        "page_id long, url string, html string",
    )
    rows = warc.chunk_rows(pages).collect()
    assert max(len(r.data) for r in rows) <= warc.CHUNK
    assert sorted(r.record_id.split(":")[2] for r in rows if r.chunk == 0) == ["1", "2", "3", "4", "4", "none"]
    assert len({r.record_id for r in rows}) == 6
    record = sorted((r for r in rows if r.record_id.startswith("urn:page:2:")), key=lambda r: r.chunk)
    header, payload = b"".join(r.data for r in record).split(b"\r\n\r\n", 1)
    assert payload == ("é" * 100_000).encode() + b"\r\n\r\n"
    assert b"Content-Length: 200000" in header
    plan = {(r.page_id, r.payload_bytes): r.refers_to for r in warc.plan_records(pages).collect()}
    assert plan == {(1, 200_000): 2, (2, 200_000): None, (3, 0): None, (None, 1): 4, (4, 1): None}
