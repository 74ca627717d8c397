"""Repair of conversation structure by generalised LR parsing.

A conversation's role initials must read `(s?(ua)+)?`, which is the left-recursive grammar

    C -> (nothing) | P | s P        P -> u a | P u a

A parser reads the turns with edits: keep, rerole, delete, insert. Its stacks share a graph.
Left recursion keeps them short, so below the tops the graph never changes (`BELOW`), and a link
(top, state below) stands for a whole stack. Where two parses meet in one link, the lesser of
(cost, audit) stays: both have read the same turns, so whatever follows costs them alike, and no
audit is a proper prefix of another one of equal cost.

Conversations of up to `LIMIT` turns are parsed whole. Longer ones are cut into chunks by a range
partitioning over (conversation, turn), so that one of any length is spread over tasks; each chunk
is parsed from every link, and one light pass chains the results. The rows are the same either way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.storage import stored

# States of the parser: nothing read, s, first u, P, s P, u after P.
START, SYSTEM, USER, PAIRS, SYSTEM_PAIRS, NEXT_USER = range(6)
SHIFT = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (PAIRS, "u"): NEXT_USER,
    (SYSTEM_PAIRS, "u"): NEXT_USER,
}
#: State after reducing to P on top of a state; what lies below the states of one link.
GOTO = {START: PAIRS, SYSTEM: SYSTEM_PAIRS}
BELOW = {SYSTEM: START, PAIRS: START, SYSTEM_PAIRS: SYSTEM}
Link = tuple[int, int]
Best = tuple[int, str]
FIRST: Link = (START, -1)
LINKS: list[Link] = [
    FIRST,
    (SYSTEM, START),
    (USER, START),
    (USER, SYSTEM),
    (PAIRS, START),
    (SYSTEM_PAIRS, SYSTEM),
    (NEXT_USER, PAIRS),
    (NEXT_USER, SYSTEM_PAIRS),
]
ACCEPTED = (START, PAIRS, SYSTEM_PAIRS)


def _move(link: Link, initial: str) -> Link | None:
    """The top link after shifting `initial` and the reductions that follow."""
    top, below = link
    if initial == "a" and top in (USER, NEXT_USER):
        base = below if top == USER else BELOW[below]  # pops `u a` or `P u a`
        return GOTO[base], base
    state = SHIFT.get((top, initial))
    return None if state is None else (state, top)


MOVES = {(link, i): to for link in LINKS for i in "sua" if (to := _move(link, i))}
#: The one initial of a new or changed role that each link can take.
WANTED = {link: i for link in LINKS for i in "ua" if (link, i) in MOVES}
ROLES = {"u": "user", "a": "assistant"}

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Conversations of more turns are parsed in chunks of at most this many different turns.
CHUNK_BITS = 12
LIMIT = 1 << CHUNK_BITS
WHITE = " \t\n\x0b\x0c\r"

COUNTS = ["blank", "duplicate", "truncated", "illegal"]
PIECE = (
    "piece long, whole boolean, text string, n_turns long, audit string, cost long, blank long, "
    "duplicate long, truncated long, illegal long, first string, last string, gaps long"
)


def _put(frontier: dict[Link, Best], link: Link, value: Best) -> bool:
    if link in frontier and frontier[link] <= value:
        return False
    frontier[link] = value
    return True


def _with_inserts(frontier: dict[Link, Best]) -> dict[Link, Best]:
    waiting = list(frontier)
    while waiting:
        link = waiting.pop()
        cost, audit = frontier[link]
        to = MOVES[link, WANTED[link]]
        if _put(frontier, to, (cost + INSERT, audit + "I")):
            waiting.append(to)
    return frontier


def parse(turns: list, start: dict[Link, Best]) -> dict[Link, Best]:
    """Best (cost, audit) per link after `turns`, a list of (initial, fault, copies). Copies
    beyond the first are duplicates."""
    frontier = _with_inserts(dict(start))
    for initial, fault, copies in turns:
        after: dict[Link, Best] = {}
        late = TRUNCATED if fault == "truncated" else 0
        lost = fault in ("blank", "duplicate")
        for link, (cost, audit) in frontier.items():
            _put(after, link, (cost + DELETE, audit + "D"))
            if lost:
                continue
            if (link, initial) in MOVES:
                _put(after, MOVES[link, initial], (cost + late, audit + "K"))
            if WANTED[link] != initial:
                _put(after, MOVES[link, WANTED[link]], (cost + REROLE + late, audit + "R"))
        if copies > 1:
            more = copies - 1
            after = {k: (c + DELETE * more, a + "D" * more) for k, (c, a) in after.items()}
        frontier = _with_inserts(after)
    return frontier


def apply_audit(turns: list, audit: str, link: Link = FIRST) -> Iterator[str]:
    """The repaired lines `role:text` of `turns`, a list of (role, text, copies)."""
    rows = iter([(role, text) for role, text, copies in turns for _ in range(copies)])
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            link = MOVES[link, role[:1]]
        else:
            role = ROLES[WANTED[link]]
            link = MOVES[link, WANTED[link]]
        yield f"{role}:{text}"


def fault(text: str) -> str | None:
    end = text.rstrip(WHITE)
    return "blank" if not end else None if end[-1] in ".!?" else "truncated"


def _counted(initials: list, faults: list) -> dict:
    """Counts over turns listed one by one."""
    pairs = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:], strict=False))
    counts = {k: faults.count(k) for k in COUNTS[:3]} | {"illegal": pairs}
    return counts | {"first": initials[0] if initials else None, "last": initials[-1] if initials else None}


def _piece(rows: list) -> dict:
    """One whole conversation; rows are (turn, role, text, copies) in order."""
    seen, turns, kinds = set(), [], []
    for _, role, text, copies in rows:
        for _ in range(copies):
            kind = fault(text)
            if kind != "blank" and (role, text) in seen:
                kind = "duplicate"
            seen.add((role, text))
            turns.append((role, text, 1))
            kinds.append(kind)
    initials = [role[:1] for role, _, _ in turns]
    ends = parse([(i, k, 1) for i, k in zip(initials, kinds, strict=True)], {FIRST: (0, "")})
    cost, audit = min(value for link, value in ends.items() if link[0] in ACCEPTED)
    lines = list(apply_audit(turns, audit))
    days = {turn for turn, _, _, copies in rows if copies and turn is not None}
    gaps = max(days) - min(days) + 1 - len(days) if days else 0
    made = {"piece": 0, "whole": True, "text": "\n".join(lines), "n_turns": len(lines), "gaps": gaps}
    return made | {"audit": audit, "cost": cost} | _counted(initials, kinds)


def _whole(batches):
    """Rows sorted by conversation become one piece per conversation."""
    schema, name, rows, out, none = None, None, [], [], True

    def flush():
        return pa.RecordBatch.from_pylist(out, schema)

    for batch in batches:
        if schema is None:
            schema = pa.schema([batch.schema.field("conv_id"), *_piece_fields()])
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies")]
        for conv, *row in zip(*columns, strict=True):
            if not none and conv != name:
                out.append({"conv_id": name} | _piece(rows))
                rows = []
                if len(out) >= 1000:
                    yield flush()
                    out.clear()
            name, none = conv, False
            rows.append(row)
    if not none:
        out.append({"conv_id": name} | _piece(rows))
        yield flush()


def _piece_fields() -> list[pa.Field]:
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return [pa.field(n, types[t]) for n, t in (x.split() for x in PIECE.split(", "))]


def _chunk_turns(table: pa.Table) -> list:
    columns = ("at", "role", "text", "copies", "again")
    return sorted(zip(*(table.column(c).to_pylist() for c in columns), strict=True))


def _initial_kinds(rows: list) -> list:
    turns = []
    for _, role, text, copies, again in rows:
        kind = fault(text)
        if again and kind != "blank":
            kind = "duplicate"
        turns.append((role[:1], kind, copies))
    return turns


def _chunk_links(table: pa.Table) -> pa.Table:
    """Best edits of a chunk from every link to every link."""
    turns = _initial_kinds(_chunk_turns(table))
    made = [
        (LINKS.index(start), LINKS.index(end), cost, audit)
        for start in LINKS
        for end, (cost, audit) in parse(turns, {start: (0, "")}).items()
    ]
    key = [table.column(c).slice(0, 1).combine_chunks().take(pa.array([0] * len(made))) for c in ("conv_id", "piece")]
    values = [pa.array(list(c), t) for c, t in zip(zip(*made, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.string()), strict=True)]
    return pa.Table.from_arrays([*key, *values], ["conv_id", "piece", "start", "end", "cost", "audit"])


def _chained(batches):
    """Chunks' results, sorted by conversation and chunk, become the best edits of each chunk."""
    schema = None
    name, piece, links, frontier = None, None, {}, None

    def step():
        """Frontier: link -> ((cost, audit), way back)."""
        after: dict = {}
        for (start, end), (cost, audit) in links.items():
            if start in frontier:
                (before, edits), back = frontier[start]
                value = (before + cost, edits + audit)
                if end not in after or value < after[end][0]:
                    after[end] = (value, (back, piece, start, cost, audit))
        return after

    def finish():
        ends = [v for link, v in step().items() if LINKS[link][0] in ACCEPTED]
        _, way = min(ends, key=lambda x: x[0])
        while way:
            way, *row = way
            yield [name, *row]

    def batch_of(rows):
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        if schema is None:
            fields = [batch.schema.field(c) for c in ("conv_id", "piece", "start", "cost", "audit")]
            schema = pa.schema(fields)
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", "start", "end", "cost", "audit")), strict=True)
        for conv, part, start, end, cost, audit in rows:
            if frontier is None or conv != name:
                if frontier is not None:
                    yield batch_of(finish())
                name, piece, links, frontier = conv, part, {}, {0: ((0, ""), None)}
            elif part != piece:
                frontier, piece, links = step(), part, {}
            links[start, end] = (cost, audit)
    if frontier is not None:
        yield batch_of(finish())


def _chunk_piece(rows_table: pa.Table, edits: pa.Table) -> pa.Table:
    rows = _chunk_turns(rows_table)
    start, cost, audit = (edits.column(c)[0].as_py() for c in ("start", "cost", "audit"))
    lines = list(apply_audit([(r, t, n) for _, r, t, n, _ in rows], audit, LINKS[start]))
    initials, kinds = [], []
    for initial, kind, copies in _initial_kinds(rows):
        initials += [initial] * copies
        kinds += [kind] + ["blank" if kind == "blank" else "duplicate"] * (copies - 1)
    made = {"whole": False, "text": "\n".join(lines), "n_turns": len(lines), "audit": audit, "cost": cost, "gaps": None}
    made |= _counted(initials, kinds)
    key = {"conv_id": edits.column("conv_id")[0].as_py(), "piece": edits.column("piece")[0].as_py()}
    schema = pa.schema([edits.schema.field("conv_id"), *_piece_fields()])
    return pa.Table.from_pylist([key | made], schema)


def _long_pieces(rows: DataFrame, kind: str) -> DataFrame:
    """Pieces of conversations of any length."""
    turns = rows.where("copies > 0").groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    turns = stored(turns, "long-turns")
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = turns.groupBy("conv_id", "role", "text").agg(F.min(order).alias("least"))
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"), "least")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    marked = turns.join(firsts, same).withColumn("again", order != F.col("least")).drop("c", "r", "t", "least")
    key = ["conv_id", "turn", "role", "text"]
    placed = marked.repartitionByRange(*key).sortWithinPartitions(*key)
    placed = placed.withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("piece", F.expr(f"shiftright(at, {CHUNK_BITS})")), "long-chunks")
    edit = f"conv_id {kind}, piece long, start int, cost long, audit string"
    links = placed.groupBy("conv_id", "piece").applyInArrow(
        _chunk_links, f"conv_id {kind}, piece long, start int, end int, cost long, audit string"
    )
    links = links.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    edits = stored(links.mapInArrow(_chained, edit), "long-edits")
    by = ["conv_id", "piece"]
    pieces = placed.groupBy(*by).cogroup(edits.groupBy(*by)).applyInArrow(_chunk_piece, f"conv_id {kind}, {PIECE}")
    days = turns.where("turn IS NOT NULL").select("conv_id", "turn").distinct().groupBy("conv_id")
    gaps = days.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gap"))
    gaps = gaps.select(F.col("conv_id").alias("c"), "gap")
    joined = pieces.join(gaps, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return joined.withColumn("gaps", F.coalesce("gap", F.lit(0))).drop("c", "gap")


def damage(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows of `df` with faults planted by a checksum of
    conv_id and turn. Null roles and texts, and nulls in the checksum, are one space. A dropped
    row has no copies and no text; it stays so that its conversation is known."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    action = F.crc32(key) % 20
    text = F.coalesce("text", space)
    text = F.when(action < 2, "").when(action == 2, F.translate(text, ".!?", "")).otherwise(text)
    return df.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(action == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        text.alias("text"),
        F.when(action == 0, 0).when(action == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def repaired_pieces(rows: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, DataFrame | None]:
    """`repair` as two tables: whole conversations, and the pieces of longer ones if there are any."""
    empty = F.lit("")
    rows = rows.select("conv_id", "turn", *(F.coalesce(c, empty).alias(c) for c in ("role", "text")), "copies")
    kind = rows.schema["conv_id"].dataType.simpleString()
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n")).where(F.col("n") > limit)
    long_ones = stored(sizes.select(F.col("conv_id").alias("long_id")), "long-conversations")
    if long_ones.isEmpty():
        long_ones = None
    is_long = None if long_ones is None else F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = rows if long_ones is None else rows.join(long_ones, is_long, "left_anti")
    short = short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    whole = short.mapInArrow(_whole, f"conv_id {kind}, {PIECE}")
    return whole, None if long_ones is None else _long_pieces(rows.join(long_ones, is_long, "left_semi"), kind)


def repair(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Pieces of repaired conversations of `rows` (conv_id, turn, role, text, copies).

    Turns go by number (nulls first), then role, then text; null roles and texts are empty, a
    null conv_id is a conversation of its own. A conversation of up to `limit` turns is one piece
    (`whole`); longer ones have several, in the order of `piece`. A piece has its repaired lines
    `role:text` joined by line feeds (`text`; `n_turns` of them), its edits (`audit`: Keep, Rerole,
    Delete, Insert) and their cost, the faults found in it, and the initials of its first and last
    turn; `gaps` counts the turn numbers its conversation lacks. A conversation all of whose
    rows have no copies is one empty piece; an empty table gives none. Other columns are not read.
    """
    whole, pieces = repaired_pieces(rows, limit)
    return whole if pieces is None else whole.unionByName(pieces)


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _joined(batches):
    """Pieces sorted by conversation and piece become one row per conversation; only its
    audit is held, its text is hashed as it passes."""
    schema, name, row, last, lines, digest = None, None, None, None, 0, None
    numbers = [*COUNTS, "cost"]

    def done():
        whole = row | {"conv_id": name, "audit": "".join(row["audit"]), "repaired_sha256": digest.hexdigest()}
        return pa.RecordBatch.from_pylist([whole], schema)

    for batch in batches:
        if schema is None:
            longs = [pa.field(n, pa.int64()) for n in ("gaps", *numbers)]
            texts = [pa.field(n, pa.string()) for n in ("audit", "repaired_sha256")]
            schema = pa.schema([batch.schema.field("conv_id"), *longs, *texts])
        for at in range(batch.num_rows):
            piece = batch.slice(at, 1).to_pylist()[0]
            if row is None or piece["conv_id"] != name:
                if row is not None:
                    yield done()
                name, last, lines, digest = piece["conv_id"], None, 0, hashlib.sha256()
                row = dict.fromkeys(numbers, 0) | {"audit": [], "gaps": piece["gaps"]}
            for n in numbers:
                row[n] += piece[n]
            row["illegal"] += last is not None and last + piece["first"] not in ("su", "ua", "au")
            row["audit"].append(piece["audit"])
            last = piece["last"]
            if piece["n_turns"]:
                digest.update(("\n" if lines else "").encode() + piece["text"].encode())
                lines += piece["n_turns"]
    if row is not None:
        yield done()


def summarise(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per conversation of `rows`, as for `repair`: gaps, faults, cost, audit and the
    SHA-256 of its repaired text."""
    whole, pieces = repaired_pieces(rows, limit)
    names = [x.split()[0] for x in SUMMARY.split(", ")]
    made = whole.withColumn("repaired_sha256", F.sha2("text", 256)).select("conv_id", *names)
    if pieces is None:
        return made
    kind = pieces.schema["conv_id"].dataType.simpleString()
    parts = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return made.unionByName(parts.mapInArrow(_joined, f"conv_id {kind}, {SUMMARY}"))
