"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

Merging by lowest rank gives the one sequence of tokens in which every two neighbours are
what merging their joined bytes gives (a compatible pair). So the last token of every prefix
follows from the last tokens of shorter prefixes, and a text can be read left to right. A
state holds, for each prefix that a later byte can still build on, how its last token
reaches back; states and their transitions are made when first needed and kept. A token is
emitted as soon as the encodings of all these prefixes share it. A prefix counts as long as
the bytes after it begin some token, so the lookahead is bounded by the longest token and
mostly a few bytes. The token emitted last is part of the state too, but is kept beside it:
it matters only where all bytes not emitted yet may form one token, and there a transition
has two forms, by whether that token may follow the last one.
"""

from __future__ import annotations

import base64
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of what a worker keeps: the transducer's tables, which start anew when full, and the ids of
#: known parts, of which those not met lately go. Entries are counted by about what they take.
TRANSDUCER_BYTES, KNOWN_BYTES = 320 << 20, 128 << 20
STATE_BYTES, MOVE_BYTES, FIT_BYTES, END_BYTES, PART_BYTES = 640, 360, 260, 160, 240
#: Longer parts are not kept.
LONGEST_PART = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.begins = {token[:n] for token in ranks for n in range(1, len(token))}
        self.split: dict[bytes, tuple[bytes, bytes]] = {}
        self.clear()

    def clear(self):
        # A state is what is not emitted yet: the bytes; per prefix the size of its last token
        # and the end of its first; and the live prefixes, those after which the bytes begin
        # some token. Moves give the next state, the tokens emitted and the last of them.
        self.numbers: dict[tuple[bytes, tuple], int] = {(b"", ()): 0}
        self.states = [(b"", (), (0,), ())]
        self.moves: dict[int, tuple] = {}
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.ends: dict[int, list[int]] = {}

    def size(self) -> int:
        """About how many bytes the tables take."""
        kept = len(self.states) * STATE_BYTES + len(self.moves) * MOVE_BYTES
        return kept + len(self.fits) * FIT_BYTES + len(self.ends) * END_BYTES

    def merged(self, data: bytes, below: int | None = None) -> list[bytes]:
        """Plain merging of lowest ranks (less than `below`); used on single tokens only."""
        below = len(self.ranks) if below is None else below
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min(
                (self.ranks.get(parts[i] + parts[i + 1], len(self.ranks) + 1), i) for i in range(len(parts) - 1)
            )
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge gives this one; none for a single byte."""
        found = self.split.get(token)
        if found is None and len(token) > 1:
            parts = self.merged(token, self.ranks[token])
            if len(parts) != 2:
                raise ValueError(f"{token!r} is not made by one merge")
            found = self.split[token] = (parts[0], parts[1])
        return found

    def compatible(self, left: bytes, right: bytes) -> bool:
        """Whether merging the joined bytes gives these two tokens. Their merges are undone from
        the last on; at no time may the parts at the border merge before the next step."""
        if not left:
            return True
        ranks, bound = self.ranks, len(self.ranks)
        while True:
            joined = ranks.get(left + right)
            if joined is not None and joined < bound:
                return False
            # Undo the later of the two merges. Of equal ranks the left one comes first.
            rank_l = ranks[left] if len(left) > 1 else -1
            rank_r = ranks[right] if len(right) > 1 else -1
            if rank_l < 0 and rank_r < 0:
                return True
            if rank_l > rank_r:
                bound, left = rank_l, self.halves(left)[1]
            else:
                bound, right = rank_r + 1, self.halves(right)[0]

    def fitting(self, left: bytes, right: bytes) -> bool:
        """`compatible`, found once per pair."""
        found = self.fits.get((left, right))
        if found is None:
            found = self.fits[left, right] = self.compatible(left, right)
        return found

    def move(self, number: int, byte: int) -> tuple:
        """The token that all bytes would form, if any, and the two forms of the move: with that
        token, and without it. The second is made when first needed."""
        data, _, _, live = self.states[number]
        whole = data + bytes((byte,))
        if whole not in self.ranks or (data and (not live or live[0])):
            made = None, self.made(number, byte, False), None
        else:
            made = whole, self.made(number, byte, True), None
        self.moves[number << 8 | byte] = made
        return made

    def without(self, number: int, byte: int) -> tuple:
        whole, made, _ = self.moves[number << 8 | byte]
        other = self.made(number, byte, False)
        self.moves[number << 8 | byte] = whole, made, other
        return other

    def made(self, number: int, byte: int, as_whole: bool) -> tuple[int, tuple, bytes]:
        """Next state, tokens emitted and the last of them."""
        data, lasts, firsts, live = self.states[number]
        live = (*live, len(data))
        data += bytes((byte,))
        end = len(data)
        for start in live:
            if start == 0:
                if as_whole:
                    break
            elif data[start:] in self.ranks and self.fitting(data[start - lasts[start - 1] : start], data[start:]):
                break
        else:
            raise ValueError(f"byte {byte} is no token")
        lasts = (*lasts, end - start)
        firsts = (*firsts, firsts[start] if start else end)
        live = [p for p in live if data[p:] in self.begins]
        out, before = [], b""
        while end and all(firsts[p] == firsts[end] for p in live):
            cut = firsts[end]
            before = data[:cut]
            out.append(self.ranks[before])
            data, lasts, live, end = data[cut:], lasts[cut:], [p - cut for p in live], end - cut
            ends = [0]
            for size in lasts:
                rest = len(ends) - size
                ends.append(len(ends) if rest == 0 else ends[rest] if rest > 0 else 0)
            firsts = tuple(ends)
        to = self.numbers.get((data, lasts))
        if to is None:
            to = self.numbers[data, lasts] = len(self.states)
            self.states.append((data, lasts, firsts, tuple(live)))
        return to, tuple(out), before

    def end(self, number: int) -> list[int]:
        """Ids of what a state has not emitted."""
        pending, lasts, _, _ = self.states[number]
        end, out = len(pending), []
        while end:
            start = end - lasts[end - 1]
            out.append(self.ranks[pending[start:end]])
            end = start
        self.ends[number] = out[::-1]
        return self.ends[number]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token itself is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if self.size() >= TRANSDUCER_BYTES:
            self.clear()
        state, before, out, moves, fits = 0, b"", [], self.moves, self.fits
        for byte in piece:
            token, to, other = moves.get(state << 8 | byte) or self.move(state, byte)
            if token is not None and before:
                fit = fits.get((before, token))
                if fit is None:
                    fit = self.fitting(before, token)
                if not fit:
                    to = other or self.without(state, byte)
            state, emitted, last = to
            if emitted:
                out += emitted
                before = last
        ends = self.ends.get(state)
        return out + (self.end(state) if ends is None else ends)


class Encoder:
    """Ids of whole texts. Texts are cut at single spaces between other characters, where no
    match of the pattern can pass; the ids of the parts are kept while there is room. As a
    broadcast value it is made once per Python worker, whose later tasks find what earlier
    ones have learnt."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer, self.pattern = Transducer(ranks), regex.compile(pattern)
        # Two generations: parts of the older one come back when they are met again.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known_size = 0
        self.by_id: list[bytes] | None = None
        self.source = (ranks, pattern)
        self.edge = regex.compile(r"(?<=\S) (?=\S)")
        self.odd = regex.compile(r"\s | \s|^ | $")

    def __reduce__(self):
        return Encoder, self.source

    def tokens(self) -> list[bytes]:
        """The tokens by id; made when first asked for."""
        if self.by_id is None:
            self.by_id = [b""] * (max(self.transducer.ranks.values(), default=-1) + 1)
            for token, number in self.transducer.ranks.items():
                self.by_id[number] = token
        return self.by_id

    def part(self, text: str) -> bytes:
        """Ids of the text between two cuts: one or several matches of the pattern."""
        packed = self.older.get(text)
        if packed is not None:
            self.keep(text, packed)
            return packed
        if text.isascii() and text[1:].isalpha() and text[0] == " ":
            return self.match(text)
        matches = self.pattern.findall(text)
        if len(matches) == 1:
            return self.match(text)
        packed = b"".join([self.known.get(x) or self.older.get(x) or self.match(x) for x in matches])
        if "\n" not in text:  # parts across lines hardly come again
            self.keep(text, packed)
        return packed

    def match(self, text: str) -> bytes:
        ids = self.transducer.encode(text.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        self.keep(text, packed)
        return packed

    def keep(self, text: str, packed: bytes) -> None:
        if len(text) >= LONGEST_PART:
            return
        if self.known_size >= KNOWN_BYTES // 2:
            self.older, self.known, self.known_size = self.known, {}, 0
        self.known[text] = packed
        self.known_size += PART_BYTES + len(text) + len(packed)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        pieces = self.edge.split(text) if self.odd.search(text) else text.split(" ")
        pieces[1:] = [" " + x for x in pieces[1:]]
        known = self.known
        return b"".join([known.get(x) or self.part(x) for x in pieces])


class Utf8Stream:
    """Incremental UTF-8: takes bytes in any cuts and gives the text completed so far. A state
    machine over lead and continuation bytes says how much of the end is unfinished."""

    def __init__(self, errors: str = "replace"):
        self.errors, self.waiting = errors, b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            need = 1 if byte < 0x80 else 2 if byte >> 5 == 6 else 3 if byte >> 4 == 14 else 4 if byte >> 3 == 30 else 1
            return back if need > back else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        cut = len(data) - self.unfinished(data)
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", self.errors)

    def close(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", self.errors)


def _mapped(df: DataFrame, made: dict[str, str], function) -> DataFrame:
    """`df` with the columns `made` (replaced if there), which `function` makes from a batch."""
    keep = [c for c in df.columns if c not in made]

    def run(batches):
        for batch in batches:
            columns = [*(batch.column(c) for c in keep), *function(batch)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *made])

    schema = T.StructType([df.schema[c] for c in keep])
    for name, kind in made.items():
        schema = schema.add(name, kind)
    return df.mapInArrow(run, schema)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with column `ids`: the tokens of each whole text, packed as little-endian unsigned
    32-bit integers. Null texts are empty. The driver reads the ranks and broadcasts them."""
    encoder = df.sparkSession.sparkContext.broadcast(Encoder(read_ranks(ranks_path), pattern))
    return _mapped(df, {ids: "binary"}, lambda batch: [_encoded(batch.column(text), encoder.value)])


def _encoded(texts: pa.Array, encoder: Encoder) -> pa.Array:
    return pa.array([encoder.encode(x or "") for x in texts.to_pylist()], pa.binary())


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`df` with column `text`: the packed `ids` as text, decoded in blocks of tokens. Bytes that
    are no UTF-8 become U+FFFD; a null stays null."""
    tokens = df.sparkSession.sparkContext.broadcast({i: x for x, i in read_ranks(ranks_path).items()})
    return _mapped(df, {text: "string"}, lambda batch: [_decoded(batch.column(ids), tokens.value)])


def _decoded(packed_ids: pa.Array, tokens) -> pa.Array:
    """Texts of packed ids; `tokens` maps an id to its bytes."""

    def one(packed: bytes | None) -> str | None:
        if packed is None:
            return None
        stream, out = Utf8Stream(), []
        for at in range(0, len(packed), 1 << 16):
            block = np.frombuffer(packed[at : at + (1 << 16)], "<u4").tolist()
            out.append(stream.feed(b"".join([tokens[i] for i in block])))
        return "".join([*out, stream.close()])

    return pa.array([one(x) for x in packed_ids.to_pylist()], pa.string())


def round_trip(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """`df` with the columns that `encode` and then `decode` give, from one Python worker per task
    that holds the vocabulary once."""
    encoder = df.sparkSession.sparkContext.broadcast(Encoder(read_ranks(ranks_path), pattern))

    def both(batch):
        packed = _encoded(batch.column(text), encoder.value)
        return [packed, _decoded(packed, encoder.value.tokens())]

    return _mapped(df, {ids: "binary", decoded: "string"}, both)
