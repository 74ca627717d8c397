"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Terms of a text: four-grams of byte classes (case, digits, symbols, spacing), byte trigrams
hashed to a fixed number of slots, and runs of one repeated word. A bounded sample of labelled
texts gives the inverse document frequencies and, by a truncated singular value
decomposition, a projection to a few dimensions. Projection and labelled vectors have a fixed
size and are broadcast. Every text of the table is projected and compared with all of them
by blocked matrix products; the nearest vote with the power `SHARPNESS` of their cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.arrays import find_words, hash_words, text_blocks
from panelcast.llm.memory import returning

#: The fit takes at most so many labelled texts of each class, chosen by a hash of doc_id.
SAMPLE_PER_CLASS = 1500
DIMENSIONS = 64
NEIGHBOURS = 25
SHARPNESS = 8
THRESHOLD = 0.7
CLASS_GRAMS, TRIGRAMS, RUNS = 8**4, 2048, 8
TERMS = CLASS_GRAMS + TRIGRAMS + RUNS
#: Bytes of text whose terms a task holds as a matrix at a time.
BLOCK = 1 << 18


def _byte_classes() -> np.ndarray:
    """Lower case, upper case, digit, space, line feed, sentence mark, other mark, non-ASCII."""
    table = np.full(256, 6, np.int32)
    table[128:] = 7
    table[list(range(97, 123))] = 0
    table[list(range(65, 91))] = 1
    table[list(range(48, 58))] = 2
    table[[9, 11, 12, 13, 32]] = 3
    table[10] = 4
    table[list(b".,;:'\"-()?")] = 5
    return table


def _term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x terms."""
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(rows), sizes)
    kinds = _byte_classes()[data]
    raw = data.astype(np.int32)
    counts = np.zeros(rows * TERMS)
    if len(data) >= 4:
        last = np.repeat(offsets[1:], sizes)
        inside = (np.arange(len(data) - 3) + 4) <= last[:-3]
        grams = ((kinds[:-3] * 8 + kinds[1:-2]) * 8 + kinds[2:-1]) * 8 + kinds[3:]
        hashed = (raw[:-3] * 7919 + raw[1:-2] * 104729 + raw[2:-1] * 1299709) % TRIGRAMS
        base = (text[:-3] * TERMS)[inside]
        for codes in (grams, hashed + CLASS_GRAMS):
            counts += np.bincount(base + codes[inside], minlength=len(counts))
    starts, ends, word_offsets = find_words(data, offsets)
    words = hash_words(data, starts, ends)
    if len(words):
        owner = np.repeat(np.arange(rows), np.diff(word_offsets))
        same = np.zeros(len(words), bool)
        same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
        begins = np.flatnonzero(~same)
        lengths = np.diff(np.append(begins, len(words)))
        bins = np.minimum(np.frexp(lengths.astype(float))[1] - 1, RUNS - 1)
        own = owner[begins] * TERMS + CLASS_GRAMS + TRIGRAMS + bins
        counts += np.bincount(own, weights=lengths, minlength=len(counts))
    return counts.reshape(rows, TERMS)


def _sparse_terms(batches):
    for batch in batches:
        out = []
        for first, _, data, offsets in text_blocks(batch.column("text"), BLOCK):
            counts = _term_counts(data, offsets)
            for i, row in enumerate(counts):
                terms = np.flatnonzero(row)
                values = row[terms].astype(np.float32)
                out.append((first + i, terms.astype(np.int32).tobytes(), values.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("label"),
                pa.array([x[1] for x in out], pa.binary()),
                pa.array([x[2] for x in out], pa.binary()),
            ],
            ["doc_id", "label", "terms", "counts"],
        )


def is_held_out(doc_id: str = "doc_id"):
    """Rows that never take part in the fit; a null id has no remainder and is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS):
    """At most `per_class` labelled rows of each class. Null labels are left out, repeated
    ones averaged; a document listed twice gives one row per listing, within that bound."""
    usable = (
        labels.select("doc_id", F.col("quality").cast("double").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(~is_held_out())
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    chosen = [
        usable.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for k in (0, 1)
    ]
    # Two lists of `per_class` ids: a bounded side.
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))
    prior = usable.agg(F.avg("label")).first()[0]
    rows = docs.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "label", "text")
    # Ids may have many rows. Each task drops what is beyond the bound before the shuffle.
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    bounded = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_class)
    return bounded.drop("place"), prior


class NeighbourModel:
    """Projection and labelled vectors. Without labelled rows every score is 1/2."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, prior: float | None):
        self.labels = labels.astype(np.float32)
        n = len(counts)
        self.idf = np.log((1 + n) / (1 + (counts > 0).sum(0))) + 1
        weighted = self._weigh(counts)
        size = min(DIMENSIONS, n, TERMS)
        if n:
            probe = np.random.default_rng(7).standard_normal((TERMS, size + 8))
            span = weighted @ probe
            for _ in range(3):
                span = weighted @ (weighted.T @ np.linalg.qr(span)[0])
            basis = np.linalg.qr(span)[0]
            _, _, right = np.linalg.svd(basis.T @ weighted, full_matrices=False)
            self.projection = right[:size].T.astype(np.float32)
        else:
            self.projection = np.zeros((TERMS, 0), np.float32)
        self.idf = self.idf.astype(np.float32)
        self.vectors = self._unit(weighted @ self.projection).astype(np.float32)
        # Votes are weighed back to the classes' shares among all labelled rows.
        shares = np.array([1 - prior, prior]) if n else np.ones(2)
        found = np.array([(labels == 0).sum(), (labels == 1).sum()])
        self.votes = (shares / np.maximum(found, 1))[labels.astype(int)].astype(np.float32)

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    def _weigh(self, counts: np.ndarray) -> np.ndarray:
        return self._unit(np.log1p(counts) * self.idf)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """A text without terms has cosine 0 with every labelled one, so all vote alike."""
        if not len(self.vectors):
            return np.full(len(counts), 0.5)
        cosines = self._unit(self._weigh(counts) @ self.projection) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(cosines, near, 1), 1e-6) ** SHARPNESS
        weights = weights.astype(np.float64) * self.votes[near]
        return (weights * self.labels[near]).sum(1) / weights.sum(1)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> NeighbourModel:
    """Fit on a bounded sample: at most 2 * `per_class` rows of term counts reach the driver."""
    rows, prior = training_rows(docs, labels, per_class)
    schema = "doc_id long, label int, terms binary, counts binary"
    found = sorted(rows.mapInArrow(returning(_sparse_terms), schema).collect())
    counts = np.zeros((len(found), TERMS), np.float32)
    for i, row in enumerate(found):
        counts[i, np.frombuffer(row.terms, np.int32)] = np.frombuffer(row.counts, np.float32)
    return NeighbourModel(counts, np.array([r.label for r in found], np.int64), prior)


def score(docs: DataFrame, model: NeighbourModel, text: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) and predicted; null texts are empty. Columns of these names
    are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(batches):
        for batch in batches:
            parts = [
                shared.value.scores(_term_counts(data, offsets))
                for first, end, data, offsets in text_blocks(batch.column(text), BLOCK)
            ]
            values = np.concatenate([np.zeros(0), *parts])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(values)], [*keep, "score"]
            )

    schema = T.StructType([docs.schema[c] for c in keep]).add("score", "double")
    scored = docs.mapInArrow(returning(run), schema)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
