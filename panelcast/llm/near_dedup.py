"""Near-duplicate documents by consistent weighted sampling.

A text is the weighted set of its shingles of `SHINGLE` words. The weight of a shingle is its
term frequency times the mean inverse document frequency of its words. (With the frequency of
the shingle itself, what the members of a large group share would weigh least, and the group
would fall apart the larger it is.) Words are hashed to `IDF_SLOTS` slots, whose document
frequencies are counted over all documents.

Improved consistent weighted sampling draws `BANDS * ROWS` samples (k, t) of each set; two sets
agree in a sample with a probability equal to their weighted Jaccard similarity. Samples are
joined to `BANDS` keys. Texts that share a key are compared with one of their bucket, the
pivot: the text whose keys are shared by most others. Exact weighted similarities decide.
Buckets whose texts are then in different components (a passage that thousands of otherwise
different texts share makes such) are not compared pair by pair. Their texts go through an
exact prefix filter: with shingles ordered from rare to frequent, two texts of similarity 0.8
share one within the first fifth of the weight of each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.arrays import find_words, hash_words, splitmix, text_blocks, window_hash
from panelcast.llm.components import components
from panelcast.llm.memory import returning
from panelcast.llm.storage import stored

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
IDF_SLOTS = 1 << 18
#: Slots of the table that orders shingles by frequency; a collision costs only time.
ORDER_SLOTS = 1 << 20
SAMPLE_BLOCK = 1 << 15


# Document frequencies of words.


def _slots(data: np.ndarray, offsets: np.ndarray):
    starts, ends, word_offsets = find_words(data, offsets)
    return hash_words(data, starts, ends), word_offsets


def _frequencies(slots_of, size: int):
    """(slot, n): counts of a task's slots that occur, and under -1 the number of its texts."""

    def run(batches):
        total, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, data, offsets in text_blocks(batch.column("text")):
                total += np.bincount(slots_of(data, offsets), minlength=size)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(slots, -1), pa.int32()),
                pa.array(np.append(total[slots], rows), pa.int64()),
            ],
            ["slot", "n"],
        )

    return run


def _counted(docs: DataFrame, slots_of, size: int) -> tuple[np.ndarray, int]:
    """Counts of all slots and the number of texts; a table of fixed size."""
    cells = docs.select("text").mapInArrow(returning(_frequencies(slots_of, size)), "slot int, n long")
    found = cells.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slots, n = (found.column(c).to_numpy() for c in ("slot", "n"))
    counts, known = np.zeros(size, np.int64), slots >= 0
    counts[slots[known]] = n[known]
    return counts, int(n[~known].sum())


def _document_slots(data, offsets) -> np.ndarray:
    words, word_offsets = _slots(data, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(word_offsets))
    slots = (words % np.uint64(IDF_SLOTS)).astype(np.int64)
    return np.unique(text * IDF_SLOTS + slots) % IDF_SLOTS


def word_idf(docs: DataFrame) -> np.ndarray:
    """1 + ln((1 + documents) / (1 + document frequency)) of every slot: a table of 1 MB."""
    counts, rows = _counted(docs, _document_slots, IDF_SLOTS)
    return (1 + np.log((1 + rows) / (1 + counts))).astype(np.float32)


# Shingles and samples.


def shingles(data: np.ndarray, offsets: np.ndarray, idf: np.ndarray):
    """(offsets per text, shingle hash, weight) of distinct shingles, sorted within each text.

    A text of fewer words than a shingle has all its words as its only one; a text without
    words has none.
    """
    words, word_offsets = _slots(data, offsets)
    weights = idf[(words % np.uint64(IDF_SLOTS)).astype(np.int64)].astype(np.float64)
    upto = np.concatenate([[0], np.cumsum(weights)])
    sizes = np.diff(word_offsets)
    counts = np.where(sizes > 0, np.maximum(sizes - SHINGLE + 1, 1), 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    first = np.arange(counts.sum()) + (word_offsets[:-1] - (np.cumsum(counts) - counts))[text]
    width = np.minimum(SHINGLE, sizes)[text]
    padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    names = window_hash(padded, SHINGLE)[first]
    short = np.flatnonzero(width < SHINGLE)
    for i in short:  # at most one per text
        own = words[first[i] : first[i] + width[i]]
        names[i] = window_hash(np.append(own, np.uint64(len(own))), len(own) + 1)[0]
    mean = (upto[first + width] - upto[first]) / np.maximum(width, 1)
    # The text's number in the upper bits keeps texts apart in one sort.
    bits = np.uint64(max(1, int(len(sizes)).bit_length()))
    tagged = (text.astype(np.uint64) << (np.uint64(64) - bits)) | (names >> bits)
    order = np.argsort(tagged)
    tagged = tagged[order]
    new = np.ones(len(tagged), bool)
    new[1:] = tagged[1:] != tagged[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(tagged)))
    own = order[at]
    edges = np.concatenate([[0], np.cumsum(np.bincount(text[own], minlength=len(sizes)))])
    return edges, names[own], mean[own] * times


def _tables():
    """Gamma(2, 1) and uniform quantiles at 2**16 levels: r, 1 / r, ln c and beta."""
    levels = (np.arange(1 << 16) + 0.5) / (1 << 16)
    grid = np.concatenate([np.geomspace(1e-4, 1, 4000)[:-1], np.linspace(1, 40, 40000)])
    gamma = np.interp(levels, 1 - np.exp(-grid) * (1 + grid), grid)
    return gamma.astype(np.float32), (1 / gamma).astype(np.float32), np.log(gamma).astype(np.float32), levels.astype(np.float32)


def band_keys(edges: np.ndarray, names: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Texts x BANDS keys; texts must have shingles.

    Per sample and shingle of weight S: t = floor(ln S / r + beta), y = exp(r (t - beta)),
    a = c / (y e^r); the sample is the shingle of least a, with its t. Working blockwise keeps
    the arrays in the processor's cache.
    """
    r, inverse, log_c, beta = _tables()
    samples = BANDS * ROWS
    out = np.zeros((len(edges) - 1, samples), np.uint64)
    seeds = splitmix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    low = np.uint64(0xFFFF)
    first = 0
    while first < len(edges) - 1:
        end = int(np.searchsorted(edges, edges[first] + SAMPLE_BLOCK, "right")) - 1
        end = max(end, first + 1)
        own = slice(edges[first], edges[end])
        cuts = edges[first:end] - edges[first]
        sizes = np.diff(edges[first : end + 1])
        name, log_s = names[own], np.log(weights[own]).astype(np.float32)
        for j in range(samples):
            u = (name ^ seeds[j]) * np.uint64(0xD6E8FEB86659FD93)
            u ^= u >> np.uint64(32)
            i, k = (u & low).astype(np.intp), ((u >> np.uint64(16)) & low).astype(np.intp)
            shift = beta[(u >> np.uint64(48)).astype(np.intp)]
            t = np.floor(log_s * inverse[i] + shift)
            a = log_c[k] - r[i] * (t - shift + 1)
            least = np.minimum.reduceat(a, cuts)
            hits = np.flatnonzero(a == np.repeat(least, sizes))
            # Of equal a (rare: the levels are discrete) the least name counts, whatever the order.
            text = np.searchsorted(cuts, hits, "right") - 1
            sample = splitmix(name[hits] + t[hits].astype(np.int64).astype(np.uint64))
            begin = np.searchsorted(text, np.arange(len(cuts)))
            out[first:end, j] = np.minimum.reduceat(sample, begin)
        first = end
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(out), BANDS)).copy()
    for row in range(ROWS):
        keys = splitmix(keys * np.uint64(0x9E3779B97F4A7C15) + out[:, row::ROWS][:, :BANDS])
    return keys


def _sampler(idf):
    def run(batches):
        for batch in batches:
            keys: list = [None] * batch.num_rows
            for first, _, data, offsets in text_blocks(batch.column("text")):
                edges, names, weights = shingles(data, offsets, idf.value)
                full = np.flatnonzero(np.diff(edges))
                if len(full):
                    own = band_keys(np.append(edges[full], edges[-1]), names, weights)
                    for i, row in zip(full, own.view(np.int64), strict=True):
                        keys[first + i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "digest", "keys"],
            )

    return run


def _similarity(a, b) -> float:
    (names_a, weights_a), (names_b, weights_b) = a, b
    _, i, j = np.intersect1d(names_a, names_b, assume_unique=True, return_indices=True)
    common = np.minimum(weights_a[i], weights_b[j]).sum()
    total = weights_a.sum() + weights_b.sum() - common
    return float(common / total) if total else 0.0


def _verifier(idf):
    def sets(column):
        for _, _, data, offsets in text_blocks(column):
            edges, names, weights = shingles(data, offsets, idf.value)
            for i in range(len(edges) - 1):
                own = slice(edges[i], edges[i + 1])
                yield names[own], weights[own]

    def run(batches):
        pivot, pivot_set = None, None
        for batch in batches:
            found = []
            pivots, texts = batch.column("b").to_pylist(), batch.column("text_b")
            for row, own in enumerate(sets(batch.column("text"))):
                if pivots[row] != pivot:
                    pivot, pivot_set = pivots[row], next(sets(texts.slice(row, 1)))
                found.append(_similarity(own, pivot_set))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], ["a", "b", "similarity"]
            )

    return run


# Buckets, pivots and links.


def _node(digest: str):
    """The number of a text: 60 bits of its md5. Among 10 million texts any two share one with a
    probability of about 1 in 20,000."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _verified(pairs: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """(a, b, lo, hi, similarity) of pairs, each compared once. Both joins may be split by
    adaptive execution where one text is in many pairs; such pairs stand together, so the set
    of a pivot is built once per task."""
    pairs = pairs.select("a", "b", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    pairs = pairs.dropDuplicates(["lo", "hi"])
    left = pairs.join(texts.withColumnRenamed("node", "a"), "a")
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = left.join(right, "b").select("a", "b", "text", "text_b")
    found = rows.mapInArrow(returning(_verifier(idf)), "a long, b long, similarity double")
    pair = (F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    return stored(found.select(*pair, "similarity"), "compared")


def _linked(compared: DataFrame) -> DataFrame:
    near = compared.where(F.col("similarity") >= SIMILARITY)
    return components(near.select(F.col("lo").alias("a"), F.col("hi").alias("b")))


def linked(texts: DataFrame, buckets: DataFrame, idf) -> DataFrame:
    """(node, component) of the texts that have links. `texts`: node, text; `buckets`: key,
    node, of keys that at least two nodes have."""
    sizes = buckets.groupBy("key").agg(F.count("*").alias("size"))
    degrees = buckets.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("degree"))
    best = (
        buckets.join(degrees, "node")
        .groupBy("key")
        .agg(F.max(F.struct("degree", (-F.col("node")).alias("n"))).alias("m"))
    )
    pairs = buckets.join(best.select("key", (-F.col("m.n")).alias("pivot")), "key").where("node <> pivot")
    compared = _verified(pairs.select(F.col("node").alias("a"), F.col("pivot").alias("b")), texts, idf)
    joined = stored(_linked(compared), "linked")
    known = buckets.join(joined, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )
    split = known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = known.join(split.where("lo < hi").select("key"), "key", "left_semi").select("node", "component")
    pairs = _prefix_pairs(texts.join(mixed.distinct(), "node"), idf)
    more = _verified(pairs.join(compared, ["lo", "hi"], "left_anti"), texts, idf)
    if more.where(F.col("similarity") >= SIMILARITY).isEmpty():
        return joined
    return _linked(compared.unionByName(more))


def _shingle_slots(idf):
    def slots(data, offsets):
        return (shingles(data, offsets, idf.value)[1] % np.uint64(ORDER_SLOTS)).astype(np.int64)

    return slots


def _prefixes(idf, frequency):
    def run(batches):
        for batch in batches:
            nodes, groups = batch.column("node").to_numpy(), batch.column("component").to_numpy()
            out = []
            for first, _, data, offsets in text_blocks(batch.column("text")):
                edges, names, weights = shingles(data, offsets, idf.value)
                often = frequency.value[(names % np.uint64(ORDER_SLOTS)).astype(np.int64)]
                text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
                order = np.lexsort((names, often, text))
                upto = np.concatenate([[0], np.cumsum(weights[order])])
                totals = upto[edges[1:]] - upto[edges[:-1]]
                before = upto[:-1] - upto[edges[:-1]][text]
                inside = before <= (1 - SIMILARITY) * totals[text] * (1 + 1e-9)
                own = text[inside]
                rest = totals[own] - before[inside]
                name = names[order].view(np.int64)
                # A text's first shingle has none before it and names itself.
                previous = np.where(np.append(True, text[1:] != text[:-1])[: len(text)], name, np.roll(name, 1))
                out.append((name[inside], previous[inside], nodes[first + own], groups[first + own], totals[own], rest))
            kinds = [pa.int64()] * 4 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([x[i] for x in out]) if out else [], k) for i, k in enumerate(kinds)],
                ["shingle", "previous", "node", "component", "total", "rest"],
            )

    return run


def _prefix_pairs(open_texts: DataFrame, idf) -> DataFrame:
    """Pairs (a, b, lo, hi) of different components that may reach `SIMILARITY`.

    A text's prefix ends where the weight before a shingle exceeds a fifth of the whole: were
    the first common shingle of two texts beyond it, less than 0.8 of the weight would be
    common. The common weight is at most what is left of either text from its first common
    shingle on, and a similarity of s needs s / (1 + s) of both weights together.
    """
    return _meetings(_prefix_rows(open_texts, idf)).distinct()


def _prefix_rows(open_texts: DataFrame, idf) -> DataFrame:
    """Shingles of the texts' prefixes that several components have, with the one before each in its text."""
    open_texts = stored(open_texts, "near-open")
    context = open_texts.sparkSession.sparkContext
    frequency = context.broadcast(_counted(open_texts, _shingle_slots(idf), ORDER_SLOTS)[0].astype(np.int32))
    rows = open_texts.select("node", "component", "text").mapInArrow(
        returning(_prefixes(idf, frequency)),
        "shingle long, previous long, node long, component long, total double, rest double",
    )
    rows = stored(rows, "near-prefixes")
    mixed = rows.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return rows.join(mixed.where("lo < hi").select("shingle"), "shingle", "left_semi")


def _meetings(rows: DataFrame) -> DataFrame:
    """Pairs that share a shingle, with enough weight from it on, but not where they share the one
    before it as well: there they have met already, with more weight left. All texts have their
    shingles in one order, so a pair meets at its first common one, and a passage that many texts
    share does not repeat their pairs with each of its shingles."""
    other = rows.select(
        "shingle", F.col("previous").alias("p"), F.col("node").alias("b"), F.col("component").alias("c"),
        F.col("total").alias("t"), F.col("rest").alias("r"),
    )
    need = SIMILARITY / (1 + SIMILARITY) * (1 - 1e-9) * (F.col("total") + F.col("t"))
    enough = F.least("rest", "r") >= need
    first = (F.col("previous") != F.col("p")) | (F.col("previous") == F.col("shingle"))
    return (
        rows.withColumnRenamed("node", "a")
        .join(other, "shingle")
        .where((F.col("a") > F.col("b")) & (F.col("component") != F.col("c")) & enough & first)
        .select("a", "b", F.col("b").alias("lo"), F.col("a").alias("hi"))
    )


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, class_id, component): one row per row of `df`; digest is md5 of the text.

    Every different text is a node, whatever its doc_ids: component is the same for texts
    connected by links of at least `SIMILARITY`, and class_id the least doc_id of their rows,
    null if none has one. Null texts are empty; a text without words repeats nothing: its
    component is null and its class_id its own doc_id. Different texts of one doc_id may be in
    different components; those that link to nothing then have the same class_id.
    """
    docs = df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("digest", F.md5("text"))
    idf = df.sparkSession.sparkContext.broadcast(word_idf(docs))
    sampled = docs.mapInArrow(returning(_sampler(idf)), "doc_id long, digest string, keys array<long>")
    rows = stored(sampled, "near-samples")
    # One node per text: copies share the digest and all keys.
    distinct = (
        rows.where("keys IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("least_id"), F.first("keys").alias("keys"))
        .withColumn("node", _node("digest"))
    )
    distinct = stored(distinct, "near-nodes")
    spread = distinct.select("node", F.explode("keys").alias("key")).distinct()
    shared = spread.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = stored(spread.join(shared, "key", "left_semi"), "near-buckets")
    # One row of each text is read again: any of the least doc_id.
    wanted = distinct.join(buckets.select("node").distinct(), "node", "left_semi")
    wanted = wanted.select("node", F.col("least_id").alias("_id"), F.col("digest").alias("_d"))
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_d")))
    texts = stored(texts.select("node", "text").dropDuplicates(["node"]), "near-texts")
    joined = linked(texts, buckets, idf)
    members = stored(distinct.select("node", "least_id").join(joined, "node"), "near-members")
    least = members.groupBy("component").agg(F.min("least_id").alias("class_id"))
    named = members.select("node", "component").join(least, "component")
    classes = distinct.select("node", "least_id", F.col("digest").alias("_digest")).join(named, "node", "left")
    classes = classes.select(
        "_digest",
        F.coalesce("class_id", "least_id").alias("class_id"),
        F.coalesce("component", "node").alias("component"),
    )
    out = rows.join(classes, (F.col("digest") == F.col("_digest")) & F.col("keys").isNotNull(), "left")
    return out.select("doc_id", "digest", F.coalesce("class_id", "doc_id").alias("class_id"), "component")
