"""Removal of long passages that occur in an earlier document.

A window is `WINDOW` consecutive words of one document. Its minimiser is the least hash of
its `GRAM`-word parts. Consecutive windows with one minimiser overlap almost wholly, so they
travel as one packed string (a super-k-mer) to the bucket of the minimiser, where all windows
of equal words meet. In a bucket the windows are sorted, and each run of equal ones gives the
least document that has it.

Hot minimisers (of a passage that many documents share) would fill one bucket with strings
that differ only at their ends. Strings are counted per minimiser first, equal ones of a batch
once; the windows of a hot minimiser travel to the bucket of the least hash of their
`HOT_GRAM`-word parts, which most windows with words from outside the passage don't share. The set of hot minimisers is a bitmap of fixed size: a chance
hit in it merely deals a minimiser's windows in that finer way, the result is the same. Equal
strings of a task are sent once, with the places where they occur.

The ranges found go back to their texts by a join, for which only texts that have any are
shuffled and go to Python. A bitmap over the texts' keys tells which; it has `BITS_PER_TEXT` bits for each of them up to
a fixed size, and a chance hit in it merely shuffles a text that keeps all its words.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.arrays import (
    find_words,
    hash_words,
    sliding_min,
    splitmix,
    text_blocks,
    window_hash,
    window_starts,
    word_bytes,
)
from panelcast.llm.columns import unused
from panelcast.llm.memory import returning
from panelcast.llm.storage import small_batches, stored

WINDOW = 50
GRAM = 5
#: A minimiser with more strings than this is dealt out by longer parts of its windows.
HOT_STRINGS = 1024
HOT_GRAM = 40
BITMAP_BITS = 1 << 22
#: Text of a bucket, on average (about three times as much in strings); the number of buckets
#: follows the input.
BUCKET_BYTES = 1 << 20
LEAST_BUCKETS = 128
FLUSH_BYTES = 24 << 20
#: Bytes of text whose words a task holds as arrays at a time.
BLOCK = 1 << 19
SECOND = 0xC2B2AE3D27D4EB4F
BITS_PER_TEXT = 32
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
#: Bits of one row of the bitmap functions.
BITMAP_ROW = 8 * 4096


def _runs(data: np.ndarray, offsets: np.ndarray, hot: np.ndarray | None):
    """Super-k-mers: text, first word, end word (in the block), key, name; the words' places.

    Without `hot` the key is the minimiser; with it, windows of hot minimisers have
    a key of their own. Equal names mean equal strings.
    """
    starts, ends, word_offsets = find_words(data, offsets)
    first, text = window_starts(word_offsets, WINDOW)
    if not len(first):
        none, keys = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return none, none, none, keys, keys, (starts, ends, word_offsets)
    words = hash_words(data, starts, ends)
    least = sliding_min(window_hash(words, GRAM), WINDOW - GRAM + 1)[first]
    windows = window_hash(words, WINDOW)[first]
    key, own = least, np.zeros(len(first), bool)
    if hot is not None:
        slot = (least % np.uint64(BITMAP_BITS)).astype(np.int64)
        own = (hot[slot >> 3] >> (slot & 7) & 1).astype(bool)
        long = sliding_min(window_hash(words, HOT_GRAM), WINDOW - HOT_GRAM + 1)[first]
        key = np.where(own, splitmix(long), least)
    begin = np.ones(len(first), bool)
    begin[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(begin)
    last = np.append(at[1:], len(first)) - 1
    # A string is at most 95 words long: its first and last window hold it whole.
    name = splitmix(windows[at] + splitmix(windows[last] + (last - at).astype(np.uint64)))
    return text[at], first[at], first[last] + WINDOW, key[at], name, (starts, ends, word_offsets)


def _minimisers(batches):
    """Number of distinct super-k-mers per minimiser, within a batch."""
    for batch in batches:
        found = [_runs(data, at, None)[3:5] for _, _, data, at in text_blocks(batch.column("text"), BLOCK)]
        keys, names = (np.concatenate([np.zeros(0, np.uint64), *(x[i] for x in found)]) for i in (0, 1))
        keys = keys[np.unique(names, return_index=True)[1]]
        keys, counts = np.unique(keys, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(counts)], ["minimiser", "strings"]
        )


def hot_minimisers(docs: DataFrame) -> np.ndarray:
    """Bitmap of the slots of hot minimisers."""
    counts = docs.mapInArrow(returning(_minimisers), "minimiser long, strings long")
    sums = counts.groupBy("minimiser").agg(F.sum("strings").alias("strings"))
    return _bitmap(sums.where(F.col("strings") > HOT_STRINGS), F.col("minimiser"), BITMAP_BITS)


def _bitmap_rows(rows: DataFrame, key, bits: int) -> DataFrame:
    """(part, bits): the set of slots `key` mod `bits`, in rows of 4096 bytes, numbered from 1."""
    return (
        rows.select((F.pmod(key, F.lit(bits)) + 1).alias("at"))
        .groupBy(F.expr("bitmap_bucket_number(at)").alias("part"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits"))
    )


def _bitmap(rows: DataFrame, key, bits: int) -> np.ndarray:
    """The set of slots `key` mod `bits`, in `bits` / 8 bytes."""
    bitmap = np.zeros(max(bits, BITMAP_ROW) // 8, np.uint8)
    for row in _bitmap_rows(rows, key, bits).collect():
        bitmap[(row.part - 1) * 4096 : row.part * 4096] |= np.frombuffer(row.bits, np.uint8)
    return bitmap


def _marked(rows: DataFrame, key, ranges: DataFrame, ranges_key, name: str) -> DataFrame:
    """`rows` with column `name`: whether a row may have ranges, and surely if it has. The bitmap
    meets the rows as a broadcast table of at most `MOST_BITS` / 8 bytes."""
    count, bits = ranges.count(), LEAST_BITS
    while bits < min(count * BITS_PER_TEXT, MOST_BITS):
        bits *= 2
    part, own, slot = unused(rows, "_part", "_bits", "_slot")
    parts = _bitmap_rows(ranges, ranges_key, bits).select(F.col("part").alias(part), F.col("bits").alias(own))
    placed = rows.withColumn(slot, F.pmod(key, F.lit(bits)))
    joined = placed.join(F.broadcast(parts), F.expr(f"{slot} div {BITMAP_ROW} + 1") == F.col(part), "left")
    byte = F.expr(f"cast(conv(hex(substring({own}, cast({slot} % {BITMAP_ROW} div 8 AS int) + 1, 1)), 16, 10) AS int)")
    bit = F.expr(f"cast({slot} % 8 AS int)")
    marked = F.coalesce(F.call_function("shiftright", byte, bit).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return joined.withColumn(name, marked).drop(part, own, slot)


class _Parcel:
    """Super-k-mers of one task for one bucket: distinct strings and where they start."""

    def __init__(self):
        self.strings: dict[bytes, int] = {}
        self.places = array("q")

    def add(self, string: bytes, row: int, start: int) -> int:
        self.places.extend((self.strings.setdefault(string, len(self.strings)), row, start))
        return len(string)

    def packed(self, rows: np.ndarray, pack) -> tuple[bytes, bytes, bytes]:
        places = np.array(self.places, np.int64).reshape(-1, 3)
        own, places[:, 1] = np.unique(places[:, 1], return_inverse=True)
        strings = pack.compress(b"\n".join(self.strings))
        return strings, places.astype(np.int32).tobytes(), rows[own].tobytes()


def _dealer(hot, buckets: int):
    def parcels(batches):
        pack, waiting, rows, size = zstandard.ZstdCompressor(1), {}, [], 0

        def flush():
            table = np.concatenate(rows)
            names, packed = list(waiting), []
            for name in names:  # a parcel is let go as soon as it is packed
                packed.append(waiting.pop(name).packed(table, pack))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64()),
                    *(pa.array([x[i] for x in packed], pa.binary()) for i in range(3)),
                ],
                ["bucket", "strings", "places", "docs"],
            )

        for batch in batches:
            ids = np.stack([batch.column(n).to_numpy() for n in ("doc_id", "text_key")], axis=1)
            for first, end, data, offsets in text_blocks(batch.column("text"), BLOCK):
                text, begin, stop, keys, _, (starts, ends, word_offsets) = _runs(data, offsets, hot.value)
                base = sum(map(len, rows))
                rows.append(ids[first:end])
                spaced, at, lengths = _spaced(data, starts, ends)
                spaced = spaced.tobytes()
                dealt = zip(
                    (keys % np.uint64(buckets)).tolist(),
                    at[begin].tolist(),
                    (at[stop - 1] + lengths[stop - 1]).tolist(),
                    (text + base).tolist(),
                    (begin - word_offsets[text]).tolist(),
                    strict=True,
                )
                for bucket, a, b, row, start in dealt:
                    parcel = waiting.get(bucket)
                    if parcel is None:
                        parcel = waiting[bucket] = _Parcel()
                    size += parcel.add(spaced[a:b], row, start)
                if size > FLUSH_BYTES:
                    yield flush()
                    waiting, rows, size = {}, [], 0
        if waiting:
            yield flush()

    return parcels


def _spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The words with one space after each; where each begins, and the lengths."""
    own, begins, lengths = word_bytes(data, starts, ends)
    out = np.full(len(own) + len(starts), 32, np.uint8)
    order = np.arange(len(starts))
    out[np.arange(len(own)) + np.repeat(order, lengths)] = own
    return out, begins + order, lengths


def _unpacked(table: pa.Table):
    """Distinct strings of a bucket; (string, doc_id, text_key, start) of their places."""
    unpack, strings, places = zstandard.ZstdDecompressor(), {}, []
    for row in table.to_pylist():
        names = unpack.decompress(row["strings"]).split(b"\n")
        number = np.array([strings.setdefault(x, len(strings)) for x in names], np.int64)
        at = np.frombuffer(row["places"], np.int32).reshape(-1, 3)
        docs = np.frombuffer(row["docs"], np.int64).reshape(-1, 2)[at[:, 1]]
        places.append(np.column_stack([number[at[:, 0]], docs, at[:, 2]]))
    return list(strings), np.concatenate(places)


def _repeats(key, table):
    """Word ranges of one bucket whose windows start in a smaller document too."""
    strings, places = _unpacked(table)
    data = np.frombuffer(b"\n".join(strings), np.uint8)
    sizes = np.array([len(x) + 1 for x in strings])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    offsets[-1] -= 1
    starts, ends, word_offsets = find_words(data, offsets)
    first, string = window_starts(word_offsets, WINDOW)
    # Two independent hashes of 64 bits name a window.
    names = [
        window_hash(hash_words(data, starts, ends, *factor), WINDOW)[first]
        for factor in ((), (SECOND,))
    ]
    order = np.lexsort(names)
    new = np.ones(len(order), bool)
    new[1:] = False
    for name in names:
        new[1:] |= name[order][1:] != name[order][:-1]
    least_of_string = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(least_of_string, places[:, 0], places[:, 1])
    least = np.minimum.reduceat(least_of_string[string[order]], np.flatnonzero(new))
    earliest = np.empty(len(order), np.int64)
    earliest[order] = least[np.cumsum(new) - 1]
    windows = np.concatenate([[0], np.cumsum(np.bincount(string, minlength=len(strings)))])
    least_in = np.minimum.reduceat(earliest, windows[:-1])
    places = places[least_in[places[:, 0]] < places[:, 1]]
    count = np.diff(windows)[places[:, 0]]
    place = np.repeat(np.arange(len(places)), count)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    found = earliest[windows[places[place, 0]] + step] < places[place, 1]
    place, step = place[found], step[found]
    begin = np.ones(len(place), bool)
    begin[1:] = (place[1:] != place[:-1]) | (step[1:] != step[:-1] + 1)
    at = np.flatnonzero(begin)
    last = np.append(at[1:], len(place))[: len(at)] - 1
    own = places[place[at]]
    return pa.table(
        {
            "doc_id": own[:, 1],
            "text_key": own[:, 2],
            "first": own[:, 3] + step[at],
            "end": own[:, 3] + step[last] + WINDOW,
        }
    )


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, first, end): word ranges covered by windows of smaller documents.
    `docs` has doc_id, text_key and text, without nulls."""
    hot = docs.sparkSession.sparkContext.broadcast(hot_minimisers(docs))
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    parcels = docs.mapInArrow(
        returning(_dealer(hot, buckets)), "bucket long, strings binary, places binary, docs binary"
    )
    return parcels.groupBy("bucket").applyInArrow(
        _repeats, "doc_id long, text_key long, first long, end long"
    )


def _cutter(text: str, keep: list[str], found: str):
    def run(batches):
        for batch in batches:
            ranges = batch.column(found)
            counts = np.diff(ranges.offsets.to_numpy())
            flat = ranges.flatten()
            first, end = (flat.field(i).to_numpy() for i in (0, 1))
            row = np.repeat(np.arange(len(ranges)), counts)
            out = [_cut(*block, row, first, end) for block in text_blocks(batch.column(text), BLOCK)]
            total = [np.concatenate([np.zeros(0, np.int64), *(x[i] for x in out)]) for i in (0, 1)]
            texts = pa.array([t for x in out for t in x[2]], pa.string())
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, *map(pa.array, total), texts], [*keep, "n_words", "n_removed", "kept_text"]
            )

    return run


def _cut(begin, stop, data, offsets, row, first, end):
    starts, ends, word_offsets = find_words(data, offsets)
    own = (row >= begin) & (row < stop)
    base = word_offsets[row[own] - begin]
    marks = np.zeros(len(starts) + 1, np.int64)
    np.add.at(marks, base + first[own], 1)
    np.add.at(marks, base + end[own], -1)
    kept = np.cumsum(marks)[:-1] <= 0
    upto = np.concatenate([[0], np.cumsum(kept)])
    spaced, at, lengths = _spaced(data, starts[kept], ends[kept])
    raw = spaced.tobytes()
    edges = np.append(at, len(spaced))[upto[word_offsets]]
    texts = [
        raw[a : max(a, b - 1)].decode() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
    ]
    n_words = np.diff(word_offsets)
    return n_words, n_words - np.diff(upto[word_offsets]), texts


def dedup_substrings(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` with n_words, n_removed and kept_text (the kept words with single spaces).

    Every word covered by a window whose words also start in a document of smaller `doc_id`
    is removed. Rows of one doc_id belong to one document and don't remove from each other.
    A null text has no words; a row without doc_id is left whole. Columns named like an
    output are replaced.
    """
    made = ("n_words", "n_removed", "kept_text")
    keep = [c for c in df.columns if c not in made]
    docs = df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text")
    ).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    own_id, own_key, key, found, hit = unused(df, "_id", "_key", "_text_key", "_ranges", "_hit")
    ranges = (
        repeated_ranges(docs)
        .groupBy(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key))
        .agg(F.collect_list(F.struct("first", "end")).alias(found))
    )
    with small_batches(df.sparkSession):
        ranges = stored(ranges, "ranges")
    rows = df.select(*keep).withColumn(key, F.xxhash64(text))
    same = (F.col(doc_id).cast("long") == F.col(own_id)) & (F.col(key) == F.col(own_key))
    none = F.expr("cast(array() AS array<struct<first:long,end:long>>)")
    place = F.xxhash64(F.col(doc_id).cast("long"), F.col(key))
    rows = _marked(rows, place, ranges, F.xxhash64(own_id, own_key), hit)
    touched = rows.where(F.col(hit)).join(ranges, same, "left").withColumn(found, F.coalesce(found, none))
    schema = T.StructType([df.schema[c] for c in keep])
    schema = schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    cut = touched.select(*keep, found).mapInArrow(returning(_cutter(text, keep, found)), schema)
    # Texts without ranges, mostly the larger part, need no Python.
    words = F.coalesce(F.btrim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), F.lit(""))
    spaces = F.octet_length(words) - F.octet_length(F.replace(words, F.lit(" "), F.lit("")))
    counted = F.when(words == "", 0).otherwise(spaces + 1).cast("long")
    whole = rows.where(~F.col(hit)).select(
        *keep, counted.alias("n_words"), F.lit(0).cast("long").alias("n_removed"), words.alias("kept_text")
    )
    return cut.unionByName(whole)
