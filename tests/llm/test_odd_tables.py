"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import tracemalloc

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_queries_llm import check_packed, encoding, whole_ids

from panelcast.llm import arrays, bpe, chat, classifier, near_dedup, packing, sharding, substring_dedup, vector_search, warc
from panelcast.llm.components import components
from panelcast.llm.quality_rules import quality_rules
from panelcast.llm.record_queries import tokenizer_file
from panelcast.llm.storage import BATCH_ROWS, small_batches, stored

RANKS = P.path("byte_bpe_50k.tiktoken")


def clashing(df):
    for name in ("n_words", "ids", "decoded", "score", "predicted", "class_id", "kept", "digest", "node", "key", "_key", "sequence_id"):
        df = df.withColumn(name, F.lit("own"))
    return df


def test_bpe(spark, odd, odd_rows, empty):
    enc = encoding()
    back = bpe.decode(bpe.encode(clashing(odd), RANKS, P.PATTERN), RANKS).collect()
    assert sorted(r.decoded for r in back) == sorted(r[1] or "" for r in odd_rows)
    for r in back:
        assert r.ids == np.array(enc.encode_ordinary(r.text or ""), "<u4").tobytes()
    assert bpe.decode(bpe.encode(empty, RANKS, P.PATTERN), RANKS).count() == 0


def test_bpe_equals_library_on_random_texts():
    enc, own, pick = encoding(), bpe.Encoder(bpe.read_ranks(RANKS), P.PATTERN), random.Random(5)
    parts = ["a", "é", "日", "🎉", " ", "  ", "\n", "'s", "'", "1", "#", " ", "-", "_", "The", "\t", "é", "....", "====", "\x00"]
    for _ in range(1500):
        text = "".join(pick.choice(parts) for _ in range(pick.randrange(60)))
        assert own.encode(text) == np.array(enc.encode_ordinary(text), "<u4").tobytes()


def test_utf8_stream_in_any_cuts():
    text = "aé日🎉" * 5
    for step in (1, 2, 3, 5):
        stream, data = bpe.Utf8Stream(), text.encode()
        assert "".join(stream.feed(data[i : i + step]) for i in range(0, len(data), step)) + stream.close() == text
    broken = bpe.Utf8Stream()
    assert broken.feed(b"a\xf0\x9f") + broken.close() == "a�"


def test_top_k_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(300, 340)] + [(7, rows[7][1]), (400, None), (401, [1.0, None]), (500, [float("nan")] * 8), (None, rows[1][1]), (600, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(3)
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vector_search.top_k(df, lambda v: v % 100 == 0).collect()}
    usable = [(i, tuple(v)) for i, v in rows if i is not None and v and len(v) == 8 and not np.isnan([np.nan if x is None else x for x in v]).any()]
    whole = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in usable]
    want = {}
    for q, x in whole:
        if q % 100 == 0:
            best = sorted((-int(x @ y), i) for i, y in whole if i != q)[:10]
            want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert found == want
    assert vector_search.top_k(df.where("false"), lambda v: v % 100 == 0).count() == 0


def brute_top_k(rows, k=10):
    """(query_id, rank, vec_id, score) by the definition, in Python's integers, every row counted."""
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    found = {}
    for q, x in whole:
        if q % 100 == 0:
            found.setdefault(q, []).extend((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in whole if i != q and len(x) == len(y))
    return sorted((q, n + 1, i, -s) for q, own in found.items() for n, (s, i) in enumerate(sorted(own)[:k]))


def test_top_k_counts_every_row(spark):
    """Repeated rows, repeated queries, one vector under many ids, one huge component, vectors of other lengths."""
    pick = random.Random(4)
    rows = [(i, [pick.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(7, [2.0] * 6)] * 3 + [(100, [1.0] * 6)] * 2 + [(1000 + i, [3.0] * 6) for i in range(60)] + [(1007, [3.0] * 6)] * 4
    rows += [(300, [1e9, 0, 0, 0, 0, 1.0]), (301, [-1e9, 0, 0.5, 0, 0, 0]), (200, [1.0]), (201, [-2.0]), (202, [0.25]), (400, [1.0, 2.0])]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>").repartition(3)
    found = sorted(tuple(r) for r in vector_search.top_k(df, lambda v: v % 100 == 0).collect())
    assert found == brute_top_k(rows)


def test_top_k_beyond_floats_and_longs(spark):
    """Scores that doubles cannot tell apart are ranked exactly; those beyond a long are null."""
    rows = [(0, [2.0**30 + 0.5, 1.0]), (100, [-1e200, 3.0])] + [(i, [2.0**20, i / 1024]) for i in range(1, 30)] + [(50, [1e200, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(tuple(r) for r in vector_search.top_k(df, lambda v: v % 100 == 0).collect())
    assert found == [(q, n, i, s if abs(s) < 2**63 else None) for q, n, i, s in brute_top_k(rows)]
    numbers = [0, 1, -1, 255, 256, -255, -256, -257, 65535, -65536, 2**70, -(2**70), 2**70 + 1, 10**300]
    assert sorted(numbers) == sorted(numbers, key=vector_search.order_key)


def test_top_k_leaves_exact_vectors_unread(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v], i) for i, v in enumerate(np.floor(1024 * rng.normal(size=(4000, 16))))]
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<double>, row long")
    read = vector_search.scored_pairs(vectors, lambda v: v % 100 == 0, 10).groupBy("query_id").count().collect()
    assert len(read) == 40 and max(r["count"] for r in read) <= 64


def test_packing(spark, odd, odd_rows, empty):
    once = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check_packed(packing.pack(clashing(once), tokenizer_file("word_bpe_49k.json")).collect(), {r[0]: r[1] for r in odd_rows if r[0] is not None})
    assert packing.pack(empty, tokenizer_file("word_bpe_49k.json")).count() == 0
    everything = packing.pack(odd, tokenizer_file("word_bpe_49k.json"))
    assert everything.agg(F.sum("length")).first()[0] == sum(len(whole_ids(r[1])) for r in odd_rows)


def test_packing_of_added_tokens_in_any_case():
    with open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as definition:
        encoder = packing.WordEncoder(definition.read())
    tokens = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|StartOfText|>"]
    texts = tokens + [f"Some{t}Word, {t} {t}. END" for t in tokens] + [" ".join(tokens), "".join(tokens)]
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == whole_ids(text)[:-1], text


def test_words_before_marks_are_looked_up_apart():
    with open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as definition:
        encoder = packing.WordEncoder(definition.read())
    encoder.encode(["una ?! !!"])
    texts = ["(una) una", "ciÓn.. Σας!! e\u0301!! n\u0303a,!!", "it's' don't!' a' 's 'll.", "x<|endoftext|>!! x<|>! ＷＩＤＥ).",
             "ﬁ. İ! ᾳ! \u0958? ǅ; ½! ²a! a²! 3.. a_ _a_ \u0301! a\u0338=\u0338!", "!!! ... ?!a 中文!! ｡｡ 한.\x1c. x\u00a0y!!"]
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == whole_ids(text)[:-1], text
    # What has been met as a word and as marks is not tokenized again where they stand together.
    met = []
    encoder._direct = lambda texts: met.extend(texts) or []
    assert encoder.encode(["una?! una!!"]) == encoder.encode(["una ?! una !!"]) and not met


def test_texts_in_utf8_and_parts_met_again():
    with open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as definition:
        encoder = packing.WordEncoder(definition.read())
    texts = ["", "new new, old new", "old", "Äh, new! old <|ENDOFTEXT|> newer newer", " \n", "newest old newest, newest,"]
    wanted = [whole_ids(t)[:-1] for t in texts]
    for given in (texts, [t.encode() for t in texts]):
        for some in ([t] for t in given), [given], [given[::-1], given]:
            for group in some:
                found = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(group)]
                assert found == [wanted[given.index(t)] for t in group]
            encoder.known.clear()


def test_nearly_full_sequences_take_small_pieces(spark):
    """Texts of two partitions: one leaves room for three tokens, the other has an empty text."""
    rows = [(1, " ".join(["the"] * 2044)), (2, ""), (3, "the")]
    for others in (rows[1:2], rows[1:]):
        docs = spark.createDataFrame(spark.sparkContext.parallelize([rows[0], *others], 2), "doc_id long, text string")
        packed = packing.pack(docs, tokenizer_file("word_bpe_49k.json")).collect()
        check_packed(packed, {r[0]: r[1] for r in [rows[0], *others]})
        assert len({r.sequence_id for r in packed}) == 1


def test_bins_that_stay_behind_are_not_missed():
    """Rounds that pass on only the emptiest bins need as many sequences as rounds that pass on all."""
    rng = np.random.default_rng(5)

    def packed(carry):
        nodes = [packing.best_fit([(int(x), [{}]) for x in own]) for own in pieces]
        done = 0
        while True:
            left = []
            for bins in nodes:
                closed = carry(bins)
                done += sum(closed)
                left.append([b for b, shut in zip(bins, closed, strict=True) if not shut])
            if len(left) == 1:
                return done + len(left[0])
            groups = [sum(left[i : i + packing.FAN_IN], []) for i in range(0, len(left), packing.FAN_IN)]
            nodes = [packing.best_fit(g) for g in groups]

    for high in (300, 1100, 2047):
        pieces = [rng.integers(1, high, 400) for _ in range(64)]
        assert packed(packing._closed) <= packed(lambda bins: [False] * len(bins))


def test_all_bins_with_room_are_packed(spark):
    """Partitions with more such bins than any bound a round could have: as if one held the bins of all."""
    rng = np.random.default_rng(7)
    nodes = [rng.integers(1030, 2040, 150), *([int(x)] for x in rng.integers(2, 1000, 11)), rng.integers(1, 2047, 150), [1948], [100]]
    parts, at = [], 0
    for own in nodes:
        parts.append([(at + i, "the " * (int(n) - 1)) for i, n in enumerate(own)])
        at += len(own)
    docs = spark.createDataFrame(spark.sparkContext.parallelize(parts, len(parts)).flatMap(list), "doc_id long, text string")
    packed = packing.pack(docs, tokenizer_file("word_bpe_49k.json")).collect()
    assert sorted((r.doc_id, r.length) for r in packed) == list(enumerate(int(n) for own in nodes for n in own))
    found = {}
    for r in sorted(packed, key=lambda r: r.offset):
        assert r.offset == found.get(r.sequence_id, 0)
        found[r.sequence_id] = r.offset + r.length
    local = [packing.best_fit([(int(n), [{}]) for n in own]) for own in nodes]
    assert sorted(found.values()) == sorted(fill for fill, _ in packing.best_fit(sum(local, [])))


def test_a_small_bin_takes_the_fullest_of_many(spark):
    """It fits into all bins of the other partition, and fills the fullest."""
    rows = [(i, "the " * 1399) for i in range(100)] + [(100, "the " * 1947)] * 2
    parts = spark.sparkContext.parallelize([rows, [(101, "the " * 99)]], 2).flatMap(list)
    packed = packing.pack(spark.createDataFrame(parts, "doc_id long, text string"), tokenizer_file("word_bpe_49k.json")).collect()
    (small,) = [r for r in packed if r.doc_id == 101]
    assert small.offset == 1948 and len({r.sequence_id for r in packed}) == 102


def test_bins_that_are_there_count_as_bins():
    rng = np.random.default_rng(9)
    for high in (3, 40, 1024):
        fills = [int(x) for x in rng.integers(1025, 2049, 60)]
        items = [(int(x), [i]) for i, x in enumerate(rng.integers(1, high, 200))]
        counts = {fill: fills.count(fill) for fill in fills}
        bins = packing.best_fit(items, standing=counts)
        taken = [members[0] for _, members in bins if isinstance(members[0], tuple)]
        assert len(set(taken)) == len(taken) and all(k < counts[fill] for fill, k in taken)
        sizes = dict((i, size) for size, (i,) in items)
        assert all(fill == sum(x[0] if isinstance(x, tuple) else sizes[x] for x in members) for fill, members in bins)
        for fill, _ in taken:
            fills.remove(fill)
        whole = packing.best_fit([*((fill, [fill]) for fill, n in counts.items() for _ in range(n)), *items])
        assert sorted([*fills, *(fill for fill, _ in bins)]) == sorted(fill for fill, _ in whole)


def test_text_blocks_of_slices_and_nulls():
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["ab", None, "", "é", "cd"], kind).slice(1)
        for own, wanted in ((column, ["", "", "é", "cd"]), (column.slice(1, 2), ["", "é"]), (column.slice(0, 0), [])):
            found = [
                bytes(data[a:b]).decode()
                for _, _, data, at in arrays.text_blocks(own, 2)
                for a, b in zip(at[:-1], at[1:], strict=True)
            ]
            assert found == wanted


def test_small_batches(spark):
    def sizes():
        docs = spark.range(0, 5000, 1, 1)
        found = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [x.num_rows]}) for x in batches), "n long")
        return max(r.n for r in found.collect())

    before = spark.conf.get(BATCH_ROWS)
    with pytest.raises(ZeroDivisionError), small_batches(spark):
        assert sizes() == 1000
        with small_batches(spark, 2000):
            assert sizes() == 1000
        raise ZeroDivisionError
    assert spark.conf.get(BATCH_ROWS) == before and sizes() == 5000


def test_stored_tables_are_made_in_small_batches(spark):
    docs = spark.range(0, 5000, 1, 1)
    found = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [x.num_rows]}) for x in batches), "n long")
    assert max(r.n for r in stored(found, "sizes").collect()) == 1000


def test_hashing_words_takes_little_memory(monkeypatch):
    data = np.frombuffer(b"some words of a text " * 100_000 + b"x" * 300_000 + b" end", np.uint8)
    starts, ends, _ = arrays.find_words(data, np.array([0, len(data)]))
    tracemalloc.start()
    found = arrays.hash_words(data, starts, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * len(data)
    monkeypatch.setattr(arrays, "HASH_BYTES", 1 << 30)
    assert (found == arrays.hash_words(data, starts, ends)).all()


def test_texts_reach_the_dealer_few_at_a_time(spark, monkeypatch):
    """Neither the packing of texts nor the dealing of passages gets a whole partition as one batch."""
    seen = []
    monkeypatch.setattr(packing, "small_batches", lambda s: seen.append("pack") or small_batches(s))
    monkeypatch.setattr(substring_dedup, "small_batches", lambda s: seen.append("deal") or small_batches(s))
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    assert packing.pack(docs, tokenizer_file("word_bpe_49k.json")).count() == 2
    assert substring_dedup.dedup_substrings(docs).count() == 2
    assert {"pack", "deal"} == set(seen)


def test_best_fit_uses_the_fullest_bin():
    bins = packing.best_fit([(5, ["a"]), (3, ["b"]), (7, ["c"]), (2, ["d"]), (3, ["e"])], 10)
    assert sorted(x[0] for x in bins) == [10, 10]


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "bot", "yes"), (3, 0, "user", "hi"), (3, 1, "bot", "yes"), (3, 1, "bot", "yes"),
            (4, 0, None, None), (5, None, "user", "x"), (5, 3, "bot", "y"), (None, 0, "user", "lost"), (6, 9, "user", "hi")]
    found = {r.conv_id: (r.n_turns, r.n_copies, r.text) for r in chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(0))).collect()}
    assert found == {
        2: (2, 2, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>bot\nyes<|im_end|>\n"),
        4: (1, 1, "<|im_start|>\n<|im_end|>\n"),
        5: (2, 1, "<|im_start|>user\nx<|im_end|>\n<|im_start|>bot\ny<|im_end|>\n"),
    }


def test_quality(spark, odd, odd_rows, empty):
    found = quality_rules(clashing(odd).withColumn("keep", F.monotonically_increasing_id()))
    assert found.count() == len(odd_rows)
    assert all(not r.kept and r.base_failed for r in found.where("n_words < 20").collect())
    repeated = found.where("doc_id = 12").first()
    assert repeated.n_words == 120 and repeated.n_repeat_words == 120 and repeated.base_failed
    assert found.where("doc_id = 3").first().kept
    assert quality_rules(empty).count() == 0


def test_sharding(spark, odd, odd_rows, empty):
    limit = 30_000
    rows = odd.unionByName(spark.createDataFrame([(99, f"{i} " + "y" * 9000, "en", "s", None) for i in range(20)], odd.schema))
    found = sharding.assign_shards(clashing(rows), limit)
    assert found.count() == len(odd_rows) + 20
    for r in found.groupBy("shard").agg(F.sum("row_bytes").alias("b"), F.max("shard_bytes").alias("s"), F.max("oversized").alias("o"), F.count("*").alias("n")).collect():
        assert r.b == r.s and (r.b <= limit or (r.o and r.n == 1))
    names = [r.shard for r in found.select("shard").distinct().collect()]
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    assert sharding.assign_shards(empty, limit).count() == 0


def test_warc_empty_and_damaged(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string")
    warc.write_archives(pages.where("false"), f"{tmp_path}/none")
    assert warc.read_archives(spark, f"{tmp_path}/none").count() == 0
    broken = warc.chunk_rows(pages).withColumn("data", F.when(F.col("chunk") == 1, F.lit("abX").cast("binary")).otherwise(F.col("data")))
    broken.write.parquet(f"{tmp_path}/broken")
    try:
        warc.read_archives(spark, f"{tmp_path}/broken").collect()
    except Exception as error:
        assert "differs from its digest" in str(error)
    else:
        raise AssertionError("damage was not seen")


def test_warc_returns_every_page_row(spark, tmp_path):
    rows = [(1, "a", "x"), (1, "b", "x"), (1, None, "x"), (1, "a", "x"), (2, "c", "y"), (2, "d", "y"), (None, "e", None), (None, "f", None),
            (None, "e", None), (None, "g", "y"), (None, None, "z"), (3, "h", "z"), (None, "i", "own"), (3, "h", "other")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write_archives(pages, f"{tmp_path}/pages")
    found = warc.read_archives(spark, f"{tmp_path}/pages").collect()
    largest = {"x": 1, "y": 2, "z": 3, "other": 3}
    want = [(i, u, len(t or ""), None if largest.get(t) == i else largest.get(t)) for i, u, t in rows]
    assert sorted(((r.page_id, r.url, r.payload_bytes, r.refers_to) for r in found), key=str) == sorted(want, key=str)
    heads = [r.data.decode() for r in spark.read.parquet(f"{tmp_path}/pages").where("chunk = 0").collect()]
    responses = {h.split("WARC-Record-ID: ")[1].split("\r\n")[0] for h in heads if "WARC-Type: response" in h}
    assert {h.split("WARC-Refers-To: ")[1].split("\r\n")[0] for h in heads if "Refers-To: " in h} <= responses


def test_warc_urls_come_back(spark, tmp_path):
    urls = ["http://a/%20 b", "http://a/%2520%20b", "x\r\nWARC-Type: revisit", "é日🎉 %", "\t\x00\x7f", "", None, "a: b: c"]
    pages = spark.createDataFrame([(i, u, str(i)) for i, u in enumerate(urls)], "page_id long, url string, html string")
    warc.write_archives(clashing(pages).withColumn("payload", F.lit(b"own")).withColumn("copies", F.lit(9)), f"{tmp_path}/urls")
    found = warc.read_archives(spark, f"{tmp_path}/urls").collect()
    assert sorted((r.page_id, r.url) for r in found) == list(enumerate(urls))


def test_warc_records_in_pieces(spark, tmp_path):
    """Records whose rows lie in several files and in any order are read whole; a missing row is an error."""
    rows = [(i, "u", f"{i % 7}é" * (60_000 if i % 5 == 0 else i)) for i in range(40)] + [(3, "u", "x"), (3, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/whole")
    want = sorted(map(str, warc.read_archives(spark, f"{tmp_path}/whole").collect()))
    chunks = spark.read.parquet(f"{tmp_path}/whole")
    assert len(want) == len(rows)
    chunks.orderBy(F.rand(1)).repartition(5).write.parquet(f"{tmp_path}/mixed")
    assert sorted(map(str, warc.read_archives(spark, f"{tmp_path}/mixed").collect())) == want
    lost = chunks.where("not (record_id like 'urn:page:5:%' and chunk = 2)")
    for at, part in enumerate((lost, chunks.where("not (record_id like 'urn:page:5:%' and chunk = 0)"))):
        part.write.parquet(f"{tmp_path}/lost{at}")
        with pytest.raises(Exception, match="are missing"):
            warc.read_archives(spark, f"{tmp_path}/lost{at}").collect()


def test_warc_cuts_long_payloads(spark, tmp_path):
    """Payloads at and about the borders of pieces, and one of many pieces."""
    sizes = [0, 1, warc.CHUNK - 1, warc.CHUNK, warc.CHUNK + 1, 2 * warc.CHUNK, 40_000_003]
    pages = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "page_id long, n int")
    pages = pages.select("page_id", F.lit("u").alias("url"), F.expr("substring(repeat(concat(page_id, 'é-'), n), 1, n)").alias("html"))
    payloads = {r.page_id: r.html.encode() for r in pages.collect()}
    warc.write_archives(pages, f"{tmp_path}/long")
    assert spark.read.parquet(f"{tmp_path}/long").agg(F.max(F.octet_length("data"))).first()[0] <= warc.CHUNK
    for r in warc.read_archives(spark, f"{tmp_path}/long").collect():
        own = payloads.pop(r.page_id)
        assert r.payload_bytes == len(own) and r.payload_digest == warc.base32_sha1(hashlib.sha1(own).hexdigest())
    assert not payloads


def test_near_duplicates(spark, odd, odd_rows, empty):
    found = near_dedup.near_duplicates(clashing(odd)).select("doc_id", "class_id").collect()
    assert len(found) == len(odd_rows)
    assert {r.doc_id: r.class_id for r in found if r.doc_id is not None} == {**{i: i for i in range(14)}, 4: 3, 5: 3, 7: 6}
    assert sorted(str(r.class_id) for r in found if r.doc_id is None) == ["3", "None"]
    assert near_dedup.near_duplicates(empty).count() == 0


def test_bucket_of_one_passage_is_not_paired(spark):
    """A passage that many different texts share makes hot buckets; near copies among them are found."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [(i, passage + " " + " ".join(f"u{i}x{k}" for k in range(60))) for i in range(200)]
    texts += [(1000 + i, t.replace(f"u{i}x59", "tail")) for i, t in texts[:20]]
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found == {i: i % 1000 for i, _ in texts}


def repeated_ids():
    """Different texts under one doc_id or none, with near copies of each."""
    a, b, c, d, e = ([f"{x}{i * i % 89}" for i in range(120)] for x in "abcde")
    near = [" ".join([*own[:60], "changed", *own[61:]]) for own in (a, b, c, d)]
    a, b, c, d, e = (" ".join(own) for own in (a, b, c, d, e))
    return [(50, a), (50, b), (50, e), (60, near[0]), (61, near[1]), (None, c), (40, near[2]), (None, d), (None, near[3]), (None, d)]


def test_texts_meet_at_their_first_common_shingle(spark):
    """Every pair that shares prefix shingles with enough weight left meets, though not at each of them."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    texts = [
        " ".join(passage[rng.randrange(3) :] + [rng.choice(passage) for _ in range(rng.randrange(12))]) for _ in range(30)
    ] + ["one", "one", " ".join(passage)]
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "node long, component long, text string")
    idf = spark.sparkContext.broadcast(near_dedup.word_idf(docs))
    rows = near_dedup._prefix_rows(docs, idf)
    met = [(r.a, r.b) for r in near_dedup._meetings(rows).collect()]
    by_shingle, need = {}, near_dedup.SIMILARITY / (1 + near_dedup.SIMILARITY) * (1 - 1e-9)
    for r in rows.collect():
        by_shingle.setdefault(r.shingle, []).append(r)
    everywhere = [
        (x.node, y.node)
        for own in by_shingle.values() for x in own for y in own
        if x.node > y.node and min(x.rest, y.rest) >= need * (x.total + y.total)
    ]
    assert set(met) == set(everywhere) and (31, 30) in set(met)
    assert len(met) < 0.7 * len(everywhere)
    assert {(r.a, r.b) for r in near_dedup._prefix_pairs(docs, idf).collect()} == set(everywhere)


def test_near_duplicates_of_repeated_and_null_ids(spark):
    rows = repeated_ids()
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    names = {hashlib.md5(t.encode()).hexdigest(): k for k, (_, t) in reversed(list(enumerate(rows)))}
    classes = sorted((names[r.digest], r.class_id) for r in found)
    assert classes == [(0, 50), (1, 50), (2, 50), (3, 50), (4, 50), (5, 40), (6, 40), (7, None), (7, None), (8, None)]
    component = {names[r.digest]: r.component for r in found}
    assert component[0] == component[3] and component[1] == component[4] and component[5] == component[6] and component[7] == component[8]
    assert len(set(component.values())) == 5


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(7, 7), (8, 9), (9, 8)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 700)}, 8: 8, 9: 8}


def test_classifier(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame([(3, 1), (4, 1), (11, 0), (12, 0), (12, None), (None, 1)], "doc_id long, quality int")
    model = classifier.fit(clashing(odd), labels)
    found = classifier.score(clashing(odd), model)
    assert found.count() == len(odd_rows) and found.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    bare = classifier.fit(odd, labels.where("false"))
    assert {r.score for r in classifier.score(odd, bare).collect()} == {0.5}
    assert classifier.score(empty, model).count() == 0


def brute_cut(rows):
    """{row: kept words} by the definition."""
    starts = {}
    words = [(t or "").encode().split() for _, t, *_ in rows]
    for (i, *_), own in zip(rows, words, strict=True):
        for k in range(len(own) - 49):
            w = tuple(own[k : k + 50])
            if i is not None:
                starts[w] = min(starts.get(w, i), i)
    for (i, *_), own in zip(rows, words, strict=True):
        gone = {k + j for k in range(len(own) - 49) if i is not None and starts[tuple(own[k : k + 50])] < i for j in range(50)}
        yield i, len(own), len(gone), b" ".join(w for k, w in enumerate(own) if k not in gone).decode()


def test_substrings(spark, odd, odd_rows, empty, monkeypatch):
    want = sorted(brute_cut(odd_rows), key=str)
    for hot in (substring_dedup.HOT_STRINGS, 0):
        monkeypatch.setattr(substring_dedup, "HOT_STRINGS", hot)
        found = substring_dedup.dedup_substrings(clashing(odd))
        got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found.collect()]
        assert sorted(got, key=str) == want
        assert found.select("_key").distinct().first()[0] == "own"
    assert substring_dedup.dedup_substrings(empty).count() == 0


def test_bpe_tables_turn_over_within_their_bytes(monkeypatch):
    """Varied text fills the tables many times; they stay bounded and the ids right."""
    import tracemalloc

    monkeypatch.setattr(bpe, "TRANSDUCER_BYTES", 1 << 20)
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 1 << 19)
    enc, own, pick = encoding(), bpe.Encoder(bpe.read_ranks(RANKS), P.PATTERN), random.Random(6)
    letters, clears, clear = "abcdefghijklmnopqrstuvwxyzéèABC019-_", [], bpe.Transducer.clear
    monkeypatch.setattr(bpe.Transducer, "clear", lambda self: (clears.append(1), clear(self))[1])
    tracemalloc.start()
    for _ in range(40):
        text = " ".join("".join(pick.choice(letters) for _ in range(pick.randrange(3, 14))) for _ in range(300))
        assert own.encode(text) == np.array(enc.encode_ordinary(text), "<u4").tobytes()
        assert own.known_size < (1 << 19) + 1000
        assert own.transducer.size() < (1 << 20) + 50_000
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(clears) > 5 and held < 6 << 20


def test_bpe_round_trip_equals_both_halves(spark, odd):
    one = bpe.round_trip(clashing(odd), RANKS, P.PATTERN)
    two = bpe.decode(bpe.encode(clashing(odd), RANKS, P.PATTERN), RANKS)
    assert sorted(one.columns) == sorted(two.columns)
    columns = ["doc_id", "text", "ids", "decoded"]
    assert sorted(map(str, one.select(columns).collect())) == sorted(map(str, two.select(columns).collect()))


def test_substrings_whatever_the_bitmap_says(spark, odd, monkeypatch):
    """Chance hits in the bitmap of texts with ranges do not change the result."""
    def found():
        return sorted(map(str, substring_dedup.dedup_substrings(clashing(odd)).collect()))

    want = found()
    monkeypatch.setattr(substring_dedup, "LEAST_BITS", 2)
    monkeypatch.setattr(substring_dedup, "MOST_BITS", 2)
    assert found() == want


def test_document_frequencies_of_words(spark, odd, odd_rows, empty):
    """Every slot counts the texts that have one of its words, over all tasks."""
    counts, rows = near_dedup._counted(odd.repartition(5), near_dedup._document_slots, near_dedup.IDF_SLOTS)
    want = np.zeros(near_dedup.IDF_SLOTS, np.int64)
    for _, text, *_ in odd_rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        want[near_dedup._document_slots(data, np.array([0, len(data)]))] += 1
    assert rows == len(odd_rows) and (counts == want).all()
    counts, rows = near_dedup._counted(empty, near_dedup._document_slots, near_dedup.IDF_SLOTS)
    assert rows == 0 and not counts.any()
