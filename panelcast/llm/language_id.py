"""Language identification by hyperdimensional profiles.

Every letter has a random vector of `DIMENSIONS` signs, drawn from its code point. A trigram binds
three: the first letter's vector permuted twice, the second's once, the third's as it is, multiplied
sign by sign (as bits: rotated and exclusive-ored). A text bundles the vectors of its trigrams, a
language those of its texts; both are sums of signs, exact in any order. A text takes the language of
the largest cosine, after what all languages share is taken off the prototypes.

A trigram is centred on a letter or a combining mark of the lower-cased text; anything else, and either end,
is one boundary symbol.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.arrays import splitmix

DIMENSIONS = 1024
WORDS = DIMENSIONS // 64
UNKNOWN = "und"
#: Texts handled at once; symbols handled at once; trigrams whose vectors are made at once.
ROWS, SYMBOLS, GRAMS = 128, 1 << 17, 2048
CODE_BITS = 21


@cache
def symbol_table() -> np.ndarray:
    """Per code point: 2 for a letter, 1 for a combining mark, else 0."""
    kinds = {"L": 2, "M": 1}
    found = (kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000))
    return np.fromiter(found, np.uint8, 0x110000)


def letter_bits(codes: np.ndarray) -> np.ndarray:
    """The letters' vectors as bits, `WORDS` words each."""
    seeds = codes.astype(np.uint64)[:, None] * np.uint64(WORDS) + np.arange(WORDS, dtype=np.uint64)
    return splitmix(splitmix(seeds + np.uint64(0x9E3779B97F4A7C15)))


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """The trigrams' vectors of signs. A permutation turns a vector by a word."""
    bits = np.zeros((len(grams), WORDS), np.uint64)
    for place in range(3):
        codes = (grams >> np.uint64(CODE_BITS * (2 - place))) & np.uint64((1 << CODE_BITS) - 1)
        bits ^= np.roll(letter_bits(codes), 2 - place, axis=1)
    signs = np.unpackbits(bits.view(np.uint8), axis=1).astype(np.float32)
    signs *= -2
    signs += 1
    return signs


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, set]]:
    """(row of each trigram, trigrams, rows with letters) of parts of the texts."""
    table = symbol_table()
    rows, parts, lettered, size = [], [], set(), 0
    for row, text in enumerate(texts):
        for at in range(0, len(text), SYMBOLS):
            # A long text goes in parts, each with its neighbours' nearest symbols.
            part = text[max(at - 1, 0) : at + SYMBOLS + 1]
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
            kinds = table[codes]
            if (kinds == 2).any():
                lettered.add(row)
            symbols = np.zeros(len(codes) + 2, np.uint64)
            symbols[1:-1] = np.where(kinds > 0, codes, 0)
            first = 1 + (at > 0)
            centres = np.arange(first, min(first + SYMBOLS, first + len(text) - at))
            centres = centres[symbols[centres] > 0]
            shift = np.uint64(CODE_BITS)
            made = (((symbols[centres - 1] << shift) | symbols[centres]) << shift) | symbols[centres + 1]
            rows.append(np.full(len(made), row))
            parts.append(made)
            size += len(made)
            if size >= SYMBOLS:
                yield np.concatenate(rows), np.concatenate(parts), lettered
                rows, parts, lettered, size = [], [], set(), 0
    if parts:
        yield np.concatenate(rows), np.concatenate(parts), lettered


def bundles(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, vectors, whether the text has letters) of some rows at a time; a null is an empty text."""
    lower = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    for first in range(0, len(column), ROWS):
        texts = lower.slice(first, ROWS).to_pylist()
        out, lettered = np.zeros((len(texts), DIMENSIONS)), np.zeros(len(texts), bool)
        for rows, grams, having in _grams(texts):
            lettered[list(having)] = True
            kinds, which = np.unique(grams, return_inverse=True)
            least, many = int(rows.min()) if len(rows) else 0, len(kinds)
            span = int(rows.max()) - least + 1 if len(rows) else 0
            counts = np.bincount((rows - least) * many + which, minlength=span * many)
            counts = counts.reshape(span, many).astype(np.float32)
            for at in range(0, many, GRAMS):
                out[least : least + span] += counts[:, at : at + GRAMS] @ gram_vectors(kinds[at : at + GRAMS])
        yield first, out, lettered


def is_held_out(doc_id: str = "doc_id"):
    """Rows that are not learned from. A null id has no remainder: not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


class Prototypes:
    def __init__(self, sums: dict[str, np.ndarray]):
        self.langs = sorted(lang for lang, v in sums.items() if v.any())
        unit = _unit(np.array([sums[lang] for lang in self.langs]).reshape(-1, DIMENSIONS))
        self.shared = unit.mean(axis=0) if len(unit) > 1 else np.zeros(DIMENSIONS)
        self.vectors = _unit(unit - self.shared)

    def cosines(self, vectors: np.ndarray) -> np.ndarray:
        return _unit(_unit(vectors) - self.shared) @ self.vectors.T


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _bundled_languages(text: str, lang: str):
    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(lang).to_pylist()
            for first, vectors, _ in bundles(batch.column(text)):
                own = np.array(names[first : first + len(vectors)])
                for name in set(own.tolist()):
                    sums[name] = sums.get(name, 0) + vectors[own == name].sum(axis=0)
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * DIMENSIONS),
                    pa.array(np.arange(DIMENSIONS, dtype=np.int32)),
                    pa.array(vector.astype(np.int64)),
                ],
                ["lang", "i", "value"],
            )

    return run


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Prototypes:
    """Prototypes of the languages named in `docs`, from every text. Rows without language or text
    teach nothing, repeated rows count as often as they occur, a language whose texts have no
    letters is not learned. The driver holds one vector per language."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    parts = rows.mapInArrow(_bundled_languages("text", "lang"), "lang string, i int, value long")
    sums: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "i").agg(F.sum("value").alias("value")).collect():
        sums.setdefault(r.lang, np.zeros(DIMENSIONS))[r.i] = r.value
    return Prototypes(sums)


def predict(docs: DataFrame, model: Prototypes, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score (the cosine, at least 0). Texts null or without letters, and all
    texts where no language was learned, are `und` with score 0. Equal cosines go to the language first
    in order of code points. Columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def run(batches):
        langs = shared.value.langs
        for batch in batches:
            names, scores = [], [np.zeros(0)]
            for _, vectors, lettered in bundles(batch.column(text)):
                if not langs:
                    names += [UNKNOWN] * len(vectors)
                    scores.append(np.zeros(len(vectors)))
                    continue
                cosines = shared.value.cosines(vectors)
                best = cosines.argmax(axis=1)
                names += [langs[k] if known else UNKNOWN for k, known in zip(best, lettered, strict=True)]
                scores.append(np.where(lettered, np.clip(cosines.max(axis=1), 0, 1), 0.0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
                [*keep, "lang_pred", "score"],
            )

    schema = T.StructType([docs.schema[c] for c in keep]).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(run, schema)
