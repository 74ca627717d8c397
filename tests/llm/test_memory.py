"""Workers give memory back at the end of a task, and what packing keeps for later tasks is bounded."""

import re
import sys

import numpy as np

import corpus_pipeline
from panelcast.llm import classifier, memory, near_dedup, packing, quality_rules, substring_dedup
from panelcast.llm.record_queries import WORD_TOKENIZER, tokenizer_file
from panelcast.llm.storage import READ_ROWS, small_batches

SF_DIR = "/root/testdata/sf0.001"


def held() -> int:
    with open("/proc/self/smaps_rollup") as lines:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", lines.read())[1]) >> 10


def test_freed_memory_goes_back_at_the_end_of_a_task():
    last = []

    def run(batches):
        # Small arrays, so that they stand in the C library's heap; the last one stays and holds the heap's end.
        arrays = [np.ones(1 << 13) for _ in range(4000)]
        last.append(arrays[-1])
        yield from batches

    before = held()
    rows = memory.returning(run)(iter([1, 2]))
    assert next(rows) == 1 and held() > before + 200
    assert list(rows) == [2] and held() < before + 100


def test_all_stages_give_memory_back(spark, odd, monkeypatch):
    seen = set()
    for module in (quality_rules, classifier, near_dedup, substring_dedup, packing):
        own = module.__name__.rpartition(".")[2]
        monkeypatch.setattr(module, "returning", lambda run, own=own: seen.add(own) or memory.returning(run))
    stages = ("quality_rules", "classifier", "near_dedup", "substring_dedup", "packing")
    for (_, stage), own in zip(corpus_pipeline.STAGES, stages, strict=True):
        assert stage(spark, odd, SF_DIR).columns and own in seen


def test_known_parts_stand_in_a_table_of_21_mb():
    """A worker's parts, with those of one more block of texts."""
    assert sys.getsizeof(dict.fromkeys(range(packing.MAX_KNOWN + 9_000))) < 22_000_000


def test_parts_are_met_again_after_the_table_is_emptied(monkeypatch):
    with open(tokenizer_file(WORD_TOKENIZER), encoding="utf-8") as definition:
        encoder = packing.WordEncoder(definition.read())
    texts = [f"word{i} again, and other{i}!" for i in range(50)]
    wanted = encoder.encode(texts)
    monkeypatch.setattr(packing, "MAX_KNOWN", 10)
    assert [encoder.encode([t])[0] for t in texts] == wanted and len(encoder.known) < 30


def test_files_are_read_by_few_rows(spark):
    before = spark.conf.get(READ_ROWS)
    with small_batches(spark):
        assert int(spark.conf.get(READ_ROWS)) == 512
        with small_batches(spark, read_rows=2000):
            assert int(spark.conf.get(READ_ROWS)) == 512
    assert spark.conf.get(READ_ROWS) == before


def test_texts_without_ranges_are_not_sent_to_python(spark, odd):
    """The cutter gets only texts that may have ranges. The stage needs no words of the others."""
    stages = dict(corpus_pipeline.STAGES)
    plan = stages["quality_classifier"](spark, odd, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan
    plan = stages["repeated_passages"](spark, odd, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.count("MapInArrow") == 1 and "regexp_replace" not in plan


def test_words_of_whole_texts(spark, odd, odd_rows):
    """Odd white space, nulls and empty texts, counted without Python."""
    found = substring_dedup.dedup_substrings(odd.where("doc_id IN (0, 1, 2, 6, 10, 11)")).collect()
    texts = {r[0]: r[1] for r in odd_rows}
    assert {r.doc_id for r in found} == {0, 1, 2, 6, 10, 11}
    for row in found:
        words = re.findall(r"[^\x20\x09-\x0d]+", texts[row.doc_id] or "")
        assert (row.n_words, row.n_removed, row.kept_text) == (len(words), 0, " ".join(words))
