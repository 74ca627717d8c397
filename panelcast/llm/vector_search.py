"""Exact top-k inner product search by vector-approximation files.

Three tables are written. `vectors` has one row per different vector and id. `cells` is the
approximation: blocks of rows in which every component is one byte, the number of its cell
between the block's least and largest value of that dimension. `candidates` is what a scan of
`cells` alone leaves: per query the rows whose upper bound reaches the k-th largest lower bound of
their block, and then of all blocks. Exact vectors are joined to candidates only, in the order of
their bounds: first the `FIRST` best of each query, whose k-th exact score then decides which of
the others have to be read to make the result certain.

Equal vectors cannot be told apart by bounds, so a large group of them would be read whole. Only
the k + 1 least ids of each vector can be in a result (one of them may be the query's own), and
only those enter the approximation; repeated rows are kept as a number.

The queries are a stated set and are sent, in blocks, to every group of blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.storage import stored

CELLS = 256
QUERY_BLOCK = 256
#: Vectors of a block, and components: long vectors make blocks of fewer rows.
VECTOR_BLOCK = 4096
BLOCK_COMPONENTS = 1 << 19
LEAST_GROUPS = 24
#: Exact vectors read per query before the k-th score is first known (at least k).
FIRST = 32
LONG = 1 << 63

CELLS_SCHEMA = "dim int, rows binary, ids binary, low binary, width binary, cells binary"
QUERIES_SCHEMA = "dim int, query_rows binary, query_ids binary, queries binary"


def _blocks(batches, limit: int):
    """(dim, row numbers, ids, matrix) of up to `limit` rows of one length from a task's batches
    (row, vec_id, vector)."""

    def joined(dim, rows):
        numbers, ids, values = zip(*rows, strict=True)
        return dim, np.array(numbers, np.int64), np.array(ids, np.int64), np.stack(values)

    waiting: dict[int, list] = {}
    for batch in batches:
        column = batch.column("vector")
        flat, at = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        at = at - at[0]
        names = zip(batch.column("row").to_pylist(), batch.column("vec_id").to_pylist(), strict=True)
        for i, (number, vec_id) in enumerate(names):
            dim = int(at[i + 1] - at[i])
            own = waiting.setdefault(dim, [])
            own.append((number, vec_id, flat[at[i] : at[i + 1]].copy()))
            if len(own) >= min(limit, max(1, BLOCK_COMPONENTS // max(dim, 1))):
                yield joined(dim, waiting.pop(dim))
    for dim, rows in waiting.items():
        yield joined(dim, rows)


def _row(names, dim, *arrays):
    columns = [pa.array([dim], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)]
    return pa.RecordBatch.from_arrays(columns, names)


def _approximated(batches):
    names = [c.split()[0] for c in CELLS_SCHEMA.split(", ")]
    for dim, rows, ids, x in _blocks(batches, VECTOR_BLOCK):
        low, high = x.min(0), x.max(0)
        with np.errstate(over="ignore", invalid="ignore"):
            width = np.maximum(np.ceil((high - low + 1) / CELLS), 1)
            cells = np.nan_to_num(np.floor((x - low) / width))
        cells = np.clip(cells, 0, CELLS - 1).astype(np.uint8)
        yield _row(names, dim, rows, ids, low, width, cells)


def _query_blocks(batches):
    names = [c.split()[0] for c in QUERIES_SCHEMA.split(", ")]
    for dim, rows, ids, x in _blocks(batches, QUERY_BLOCK):
        yield _row(names, dim, rows, ids, x)


def score_bounds(queries, low, width, cells):
    """(lower, upper) bounds of every inner product of a query and a vector known by its cells.

    A component of cell c lies in [low + c * width, low + (c + 1) * width - 1]. What floats may
    lose is added as slack where numbers are too large to be exact."""
    with np.errstate(over="ignore", invalid="ignore"):
        base = (queries @ low)[:, None] + (queries * width) @ cells.T.astype(np.float64)
        ends = queries * (width - 1)
        reach = np.abs(queries) @ (np.abs(low) + (CELLS + 1) * width)
        slack = np.where(reach < 2.0**52, 0.0, reach * (len(low) + 16) * 2.0**-50)
        lower = base + (np.minimum(ends, 0).sum(1) - slack)[:, None]
        upper = base + (np.maximum(ends, 0).sum(1) + slack)[:, None]
    lower[~np.isfinite(lower)], upper[~np.isfinite(upper)] = -np.inf, np.inf
    return lower, upper


def _scanned(k: int):
    names = ["query_row", "query_id", "row", "vec_id", "lower", "upper"]

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                b = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                rows, ids = (np.frombuffer(b[c], np.int64) for c in ("rows", "ids"))
                low, width = (np.frombuffer(b[c], np.float64) for c in ("low", "width"))
                cells = np.frombuffer(b["cells"], np.uint8).reshape(len(ids), b["dim"])
                query_rows, query_ids = (np.frombuffer(b[c], np.int64) for c in ("query_rows", "query_ids"))
                queries = np.frombuffer(b["queries"], np.float64).reshape(len(query_ids), b["dim"])
                lower, upper = score_bounds(queries, low, width, cells)
                own = query_ids[:, None] == ids
                lower[own] = -np.inf
                n = min(k, len(ids))
                floor = np.partition(lower, len(ids) - n, axis=1)[:, len(ids) - n]
                q, v = np.nonzero((upper >= floor[:, None]) & ~own)
                columns = [query_rows[q], query_ids[q], rows[v], ids[v], lower[q, v], upper[q, v]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


def order_key(n: int) -> bytes:
    """Bytes that sort as the integers do, of any size."""
    size = (abs(n).bit_length() + 7) // 8
    if n >= 0:
        return b"\1" + size.to_bytes(2, "big") + n.to_bytes(size, "big")
    return b"\0" + (65535 - size).to_bytes(2, "big") + ((1 << 8 * size) - 1 + n).to_bytes(size, "big")


def _scored(batches):
    """Exact scores of rows with both vectors, q and x. `sure` is a float not above the score."""
    for batch in batches:
        q, x = batch.column("q"), batch.column("x")
        sizes = q.value_lengths().to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        a, b = (c.flatten().to_numpy(zero_copy_only=False) for c in (q, x))
        with np.errstate(over="ignore"):
            product, reach = a * b, np.abs(a * b)
        scores = []
        for i in range(batch.num_rows):
            part = slice(at[i], at[i + 1])
            if reach[part].sum() < 2.0**52:
                scores.append(int(product[part].sum()))
            else:
                scores.append(sum(int(u) * int(v) for u, v in zip(a[part].tolist(), b[part].tolist(), strict=True)))
        kept = [batch.column(c) for c in ("query_row", "query_id", "row", "vec_id")]
        yield pa.RecordBatch.from_arrays(
            [
                *kept,
                pa.array([s if -LONG <= s < LONG else None for s in scores], pa.int64()),
                pa.array([order_key(s) for s in scores], pa.binary()),
                pa.array([_below(s) for s in scores], pa.float64()),
            ],
            ["query_row", "query_id", "row", "vec_id", "score", "key", "sure"],
        )


def _below(n: int) -> float:
    try:
        return float(n) if abs(n) < 1 << 53 else math.nextafter(float(n), -math.inf)
    except OverflowError:
        return -math.inf if n < 0 else np.finfo(float).max


def quantised(df: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(vec_id, vector) of the usable rows: floor(scale * x) of each component x as double, kept
    as a double, which holds it exactly. Vectors null or with null, NaN or infinite components
    (after scaling) take no part, nor do rows without id."""

    def whole(x):
        y = x.cast("double") * F.lit(float(scale))
        # From 2**53 on doubles are whole; adding 0 turns -0 into 0.
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y) + F.lit(0.0)

    finite = F.forall("vector", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(F.col(embedding), whole).alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(finite)


def _first(df: DataFrame, n: int, order, *keys: str) -> DataFrame:
    """The first `n` rows of each group; tasks drop others before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= n).drop("place")


def _candidates(vectors: DataFrame, is_query, k: int) -> DataFrame:
    """(query_row, query_id, row, vec_id, upper) whose bounds do not rule them out, from a scan of
    the approximation."""
    kept = _first(vectors, k + 1, ["vec_id"], "vector")
    cells = stored(kept.select("row", "vec_id", "vector").mapInArrow(_approximated, CELLS_SCHEMA), "cells")
    asked = vectors.where(is_query(F.col("vec_id"))).select("row", "vec_id", "vector")
    groups = max(LEAST_GROUPS, cells.count())
    sent = asked.mapInArrow(_query_blocks, QUERIES_SCHEMA)
    sent = sent.withColumn("group", F.expr(f"explode(sequence(0L, {groups - 1}L))"))
    met = cells.withColumn("group", F.pmod(F.xxhash64("rows"), F.lit(groups))).join(sent, ["dim", "group"])
    schema = "query_row long, query_id long, row long, vec_id long, lower double, upper double"
    found = stored(met.drop("group").mapInArrow(_scanned(k), schema), "candidates")
    best = _first(found.select("query_row", "lower", "row"), k, [F.desc("lower"), "row"], "query_row")
    floor = best.groupBy("query_row").agg(F.min("lower").alias("floor"), F.count("*").alias("n"))
    # Fewer than k candidates rule nothing out.
    found = found.join(floor, "query_row").where((F.col("n") < k) | (F.col("upper") >= F.col("floor")))
    return found.select("query_row", "query_id", "row", "vec_id", "upper")


def scored_pairs(vectors: DataFrame, is_query, k: int) -> DataFrame:
    """(query_row, query_id, row, vec_id, score, key) of all pairs whose exact vectors are read:
    more than are in the result, but every one that is. `vectors` has row, vec_id and vector."""
    candidates = stored(_candidates(vectors, is_query, k), "bounded")
    names = ["query_row", "query_id", "row", "vec_id"]

    def read(pairs: DataFrame) -> DataFrame:
        own = vectors.select(F.col("row").alias("query_row"), F.col("vector").alias("q")).where(
            is_query(vectors["vec_id"])
        )
        both = pairs.select(*names).join(vectors.select("row", F.col("vector").alias("x")), "row").join(own, "query_row")
        schema = "query_row long, query_id long, row long, vec_id long, score long, key binary, sure double"
        return both.select(*names, "q", "x").mapInArrow(_scored, schema)

    order = [F.desc("upper"), "vec_id", "row"]
    first = _first(candidates, max(k, FIRST), order, "query_row")
    known = stored(read(first), "first")
    certain = _first(known.select("query_row", "key", "sure", "row"), k, [F.desc("key"), "row"], "query_row")
    certain = certain.groupBy("query_row").agg(F.min("sure").alias("sure"), F.count("*").alias("n"))
    left = candidates.join(certain.where(F.col("n") >= k), "query_row").where(F.col("upper") >= F.col("sure"))
    rest = left.join(known.select("query_row", "row"), ["query_row", "row"], "left_anti")
    return known.unionByName(read(rest)).drop("sure")


def top_k(
    df: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 1024
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where `is_query` holds, its `k` best other
    rows by inner product of the scaled vectors, ties to the smaller vec_id.

    Only vectors of one length are compared. Rows with the query's vec_id are no partners of it.
    Every row counts: repeated rows are as many partners, and the pairs of repeated queries are
    ranked together. Scores are exact at any size and ranked so; one beyond a long is null. Empty
    tables give no rows; columns of other names play no part.
    """
    rows = quantised(df, vec_id, embedding, scale)
    rows = rows.groupBy("vec_id", "vector").agg(F.count("*").alias("copies"))
    vectors = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    found = scored_pairs(vectors, is_query, k)
    repeated = vectors.where("copies > 1")
    found = found.join(repeated.select("row", F.col("copies").alias("a")), "row", "left")
    found = found.join(repeated.select(F.col("row").alias("query_row"), F.col("copies").alias("b")), "query_row", "left")
    times = F.expr(f"least({k}L, coalesce(a, 1L) * coalesce(b, 1L))")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), times.cast("int"))))
    order = Window.partitionBy("query_id").orderBy(F.desc("key"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
