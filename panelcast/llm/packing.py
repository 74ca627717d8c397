"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents longer than a sequence are cut; whole pieces are sequences of their own. The rest is
packed in two rounds: every partition packs its pieces best-fit, longest first. Then all bins of
all partitions that have room, were it for one token, are packed best-fit as items. A bin is a row
with its members, at most `LENGTH` of them, so rows stay small.

The second round needs no task that holds all bins. Two bins over half can't be joined, so each
stands for itself, and bins of one fill are interchangeable: a count by fill describes them all.
After best fit at most one bin of a partition is no more than half full. One task gets these
small bins, without members, and the counts, and says where each small bin goes: behind the k-th
of all bins of a fill, or behind another small one. A bin's k follows from the counts of the
partitions before its own. Only small bins get a new place; all others stay where they were written.
Afterwards no two sequences could be joined.
"""

from __future__ import annotations

import os
import string
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.memory import returning
from panelcast.llm.storage import scratch_path, small_batches, stored

LENGTH = 2048
END = 0
#: Partitions that meet in one in the tree of rounds that tests hold the packing against.
FAN_IN = 8
#: Distinct parts of texts whose ids a worker keeps. From 699,051 on their table would take twice as much.
MAX_KNOWN = 690_000
MARKS = string.punctuation.encode()
PIECE = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>"
BINS = f"fill long, members array<{PIECE}>, closed boolean, bin long, rank long"
PLACES = "id long, fill long, k long, head long, base long"


def _stays_letters(text: str) -> bool:
    """Whether all are letters, also when normalised: some become a letter and a mark, which joins marks after it."""
    return text.isalpha() and unicodedata.normalize("NFC", text).lower().isalpha()


class _Known(dict):
    """Ids of parts of texts. Parts asked for by ``[]`` that are not there give None and are noted in `missed`."""

    __slots__ = ("missed",)

    def __missing__(self, part: bytes) -> None:
        self.missed.append(part)


class WordEncoder:
    """Ids of whole texts by a tokenizer that lower-cases, splits at white space and encodes
    runs of letters, digits and other marks apart. So the ids of a text are those of its parts
    between white space, a part's ASCII letters may be lower-cased first, and marks after a
    letter stand alone. Added tokens are found before letters are lower-cased, so a part that
    holds the letters of one in any case stays as it is. Distinct parts are encoded once and kept while there is room. Words of
    letters only are encoded many at a time: each ends with a token that ends a word. A word with
    ASCII marks after it is looked up as the word and the marks, which are one run.

    As a broadcast value it is made once per Python worker and serves all its tasks.
    """

    JOINED = 256

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.definition, self.tokenizer = definition, Tokenizer.from_str(definition)
        self.known = _Known()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [x.content.encode().lower() for x in added]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for x, i in vocabulary.items() if x.endswith("</w>")]] = True

    def __reduce__(self):
        return WordEncoder, (self.definition,)

    def _direct(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: list[bytes]) -> None:
        words, others = [], []
        for part in parts:
            (words if part.decode().isalpha() else others).append(part)
        groups = [words[i : i + self.JOINED] for i in range(0, len(words), self.JOINED)]
        for group, ids in zip(groups, self._direct([b" ".join(g).decode() for g in groups]), strict=True):
            packed = np.array(ids, "<u4")
            stops = np.flatnonzero(self.ends[packed]) + 1
            if len(stops) == len(group) and stops[-1] == len(packed):
                raw, stops = packed.tobytes(), (4 * stops).tolist()
                self.known.update(zip(group, (raw[a:b] for a, b in zip([0, *stops], stops)), strict=True))
            else:  # letters that normalise to something else
                others += group
        for part, ids in zip(others, self._direct([p.decode() for p in others]), strict=True):
            self.known[part] = np.array(ids, "<u4").tobytes()

    def _parts(self, raw: bytes) -> list[bytes]:
        low = raw.lower()
        if not any(x in low for x in self.added):
            return low.split()
        pairs = zip(raw.split(), low.split(), strict=True)
        return [a if any(x in b for x in self.added) else b for a, b in pairs]

    def encode(self, texts: list[str] | list[bytes]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, of texts that may be given in UTF-8."""
        known = self.known
        if len(known) > MAX_KNOWN:
            known.clear()
        known.missed, found, upto = [], [], [0]
        for text in texts:
            found.append(list(map(known.__getitem__, self._parts(text.encode() if isinstance(text, str) else text))))
            upto.append(len(known.missed))
        if known.missed:
            self._add(set(known.missed))
        for ids, first, end in zip(found, upto, upto[1:]):
            at = -1
            for part in known.missed[first:end]:  # in the order of the places without ids
                at = ids.index(None, at + 1)
                ids[at] = known[part]
        return list(map(b"".join, found))

    def _add(self, new: set[bytes]) -> None:
        # A word before marks: both are looked up apart.
        heads = ((p, p.rstrip(MARKS)) for p in new if p[-1] in MARKS)
        cut = {p: (head, p[len(head) :]) for p, head in heads if head.isalpha() or _stays_letters(head.decode())}
        halves = {h for pair in cut.values() for h in pair if h not in self.known}
        self._learn([*(new - cut.keys()) | halves])
        self.known.update((p, self.known[a] + self.known[b]) for p, (a, b) in cut.items())


def _pieces(doc_id, packed: bytes):
    """A document's ids and the end id, cut into pieces."""
    packed += END.to_bytes(4, "little")
    for piece, at in enumerate(range(0, len(packed), 4 * LENGTH)):
        own = packed[at : at + 4 * LENGTH]
        yield {
            "doc_id": doc_id,
            "piece": piece,
            "start": at // 4,
            "length": len(own) // 4,
            "ids_crc32": zlib.crc32(own),
        }


def best_fit(items: list[tuple[int, list]], length: int = LENGTH, standing: dict[int, int] | None = None) -> list[tuple[int, list]]:
    """Bins (fill, members) of items (size, members), largest first, each into the fullest bin
    that has room. Bins stand by free places; one bit each tells which are there.

    `standing` counts bins by fill that are there before the first item. Those that get items are
    among the bins returned; the first member of the k-th of a fill, from 0, is (fill, k)."""
    free: list[list[int]] = [[] for _ in range(length + 1)]
    untouched = {length - fill: n for fill, n in (standing or {}).items() if n}
    counts, there = dict(untouched), sum(1 << room for room in untouched)
    fills, members = [], []
    for size, own in sorted(items, key=lambda x: -x[0]):
        fitting = there >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            if free[room]:
                at = free[room].pop()
            else:
                at = len(fills)
                fills.append(length - room)
                members.append([(length - room, counts[room] - untouched[room])])
                untouched[room] -= 1
            if not free[room] and not untouched.get(room):
                there &= ~(1 << room)
            members[at] = members[at] + own
            fills[at] += size
        else:
            at = len(fills)
            fills.append(size)
            members.append(own)
        room = length - fills[at]
        free[room].append(at)
        there |= 1 << room
    return list(zip(fills, members, strict=True))


def _closed(bins: list[tuple[int, list]]) -> list[bool]:
    """Which bins have no room for a single token more."""
    return [fill >= LENGTH for fill, _ in bins]


def _bin_rows(bins, closed, first: int) -> pa.RecordBatch:
    """Rows of bins, numbered in their partition from `first` on, and among those given by fill."""
    piece = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    seen, rank = Counter(), []
    for fill, _ in bins:
        rank.append(seen[fill])
        seen[fill] += 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array([x[0] for x in bins], pa.int64()),
            pa.array([x[1] for x in bins], pa.list_(piece)),
            pa.array(closed, pa.bool_()),
            pa.array(range(first, first + len(bins)), pa.int64()),
            pa.array(rank, pa.int64()),
        ],
        ["fill", "members", "closed", "bin", "rank"],
    )


def _first_round(shared, text: str, block: int = 64):
    def run(batches):
        encoder, rest, emitted = shared.value, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                texts = [x or b"" for x in part.column(text).cast(pa.large_binary()).to_pylist()]
                full = []
                for doc, packed in zip(part.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                    for piece in _pieces(doc, packed):
                        (full if piece["length"] == LENGTH else rest).append((piece["length"], [piece]))
                yield _bin_rows(full, [True] * len(full), emitted)
                emitted += len(full)
        bins = best_fit(rest)
        yield _bin_rows(bins, _closed(bins), emitted)

    return run


def _next_round(batches):
    """The place of every small bin (fill, id) among all bins, the others of which are given as counts (fill, n):
    behind the k-th standing bin of a fill, or else in the sequence of the small bin `head`; from `base` on."""
    rows = [row for batch in batches for row in batch.to_pylist()]
    standing = {row["fill"]: row["n"] for row in rows if row["id"] is None}
    # By id, as the order of arrival may change.
    small = sorted((row["id"], row["fill"]) for row in rows if row["id"] is not None)
    places = []
    for _, members in best_fit([(size, [(size, None, id)]) for id, size in small], standing=standing):
        base, (fill, k, *head) = 0, members[0]
        if not head:
            base, members = fill, members[1:]
        for size, _, id in members:
            places.append((id, None if head else fill, k, *(head or [None]), base))
            base += size
    names = ["id", "fill", "k", "head", "base"]
    columns = zip(*places) if places else [()] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names)


def pack(df: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece and its place.

    A null or empty text is the end id alone. Each row of `df` is a document of its own; its
    doc_id may be null or repeated. The driver reads the tokenizer and broadcasts it.
    """
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as definition:
        shared = spark.sparkContext.broadcast(WordEncoder(definition.read()))
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    rows = docs.mapInArrow(returning(_first_round(shared, "_text")), BINS)
    # Written once: the second round finds the bins as they are numbered here.
    path = scratch_path(spark, "packing")
    with small_batches(spark):
        rows.withColumn("node", F.spark_partition_id()).write.parquet(path)
    bins = spark.read.schema(f"{BINS}, node int").parquet(path)
    bins = bins.withColumn("id", F.shiftleft(F.col("node").cast("long"), 33) + F.col("bin"))
    is_small = F.col("fill") <= LENGTH // 2
    small = bins.where(~F.col("closed") & is_small)
    standing = bins.where(~F.col("closed") & ~is_small)
    counts = standing.groupBy("fill", "node").agg(F.count("*").alias("n"))
    total = counts.groupBy("fill").agg(F.sum("n").alias("n")).select("fill", "n", F.lit(None).cast("long").alias("id"))
    asked = total.unionByName(small.select("fill", F.lit(None).cast("long").alias("n"), "id")).repartition(1)
    places = stored(asked.mapInArrow(returning(_next_round), PLACES), "packing-places")
    before = Window.partitionBy("fill").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("fill", "node", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = standing.join(starts, ["fill", "node"]).select("fill", (F.col("start") + F.col("rank")).alias("k"), F.col("id").alias("head"))
    behind = places.where("head IS NULL").drop("head").join(numbered, ["fill", "k"])
    placed = behind.unionByName(places.where("head IS NOT NULL"), allowMissingColumns=True).select("id", "head", "base")
    moved = small.join(placed, "id").select("members", F.col("head").alias("sequence_id"), "base")
    stay = bins.where(F.col("closed") | ~is_small).select("members", F.col("id").alias("sequence_id"), F.lit(0).cast("long").alias("base"))
    done = stay.unionByName(moved)
    ends = F.transform("members", lambda m: m["length"])
    offsets = F.aggregate(
        ends,
        F.array("base"),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)),
    )
    rows = done.select("sequence_id", F.explode(F.arrays_zip("members", offsets.alias("offset"))).alias("x"))
    return rows.where("x.members IS NOT NULL").select("x.members.*", "sequence_id", F.col("x.offset").alias("offset"))
