"""Embedding whitening from a bit-sliced scatter matrix.

Every entry becomes an integer; shifted by the least of its dimension it has few bits. Bit p of one
dimension over 64 rows is one machine word, its bit plane over a block a short run of words. The
cross-product of two dimensions is the sum over their planes of 2**(a+b) times the number of ones
in the AND of planes a and b: exact, without a multiplication per row. The products of all tasks
are summed as integers of any size, centred as integers, and only then turned into doubles for
the eigenvectors. What reaches the driver is a few numbers per pair of dimensions.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.storage import stored

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
BLOCK = 8192
#: Entries beyond this after scaling are held at it, far inside a long.
REACH = 1 << 61
LIMB = 32
#: Below this ratio of eigenvalues the slower solver runs, which is exact for small ones too.
GRADED = 1e-8
PRIME = (1 << 31) - 1


def usable_vectors(batch: pa.RecordBatch, column: str):
    """(row numbers, matrix of long) per length of the batch's usable vectors: not null, not empty,
    all entries finite."""
    values = batch.column(column)
    rows = np.flatnonzero(values.is_valid().to_numpy(zero_copy_only=False))
    values = values.drop_null()
    ends = values.offsets.to_numpy().astype(np.int64)
    flat = values.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts, sizes = ends[:-1] - ends[0], np.diff(ends)
    for size in np.unique(sizes[sizes > 0]):
        own = np.flatnonzero(sizes == size)
        matrix = flat[starts[own][:, None] + np.arange(size)]
        good = np.isfinite(matrix).all(axis=1)
        if good.any():
            scaled = np.clip(np.floor(matrix[good] * SCALE), -REACH, REACH)
            yield rows[own[good]], scaled.astype(np.int64) + OFFSET


def _record(names: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(v, pa.int32() if k in ("dim", "i", "j", "limb") else pa.int64()) for k, v in names.items()], list(names)
    )


def _dimension_stats(column: str):
    """Per task, length and dimension: rows, least, largest, and the sum in two halves."""

    def run(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for _, x in usable_vectors(batch, column):
                new = [len(x), x.min(0), x.max(0), (x >> LIMB).sum(0), (x & 0xFFFFFFFF).sum(0)]
                old = found.get(x.shape[1])
                if old:
                    new = [old[0] + new[0], np.minimum(old[1], new[1]), np.maximum(old[2], new[2]), old[3] + new[3], old[4] + new[4]]
                found[x.shape[1]] = new
        for dim, (n, least, most, high, low) in found.items():
            yield _record({"dim": [dim] * dim, "i": range(dim), "n": [n] * dim, "least": least, "most": most, "high": high, "low": low})

    return run


@dataclass
class Stats:
    n: int
    least: list[int]
    widths: list[int]
    sums: list[int]


def dimension_stats(df: DataFrame, column: str) -> dict[int, Stats]:
    rows = df.select(column).mapInArrow(
        _dimension_stats(column), "dim int, i int, n long, least long, most long, high long, low long"
    )
    sums = [f(c).alias(c) for f, c in ((F.sum, "n"), (F.min, "least"), (F.max, "most"), (F.sum, "high"), (F.sum, "low"))]
    found: dict[int, list] = {}
    for r in rows.groupBy("dim", "i").agg(*sums).orderBy("dim", "i").collect():
        found.setdefault(r.dim, []).append(r)
    return {
        dim: Stats(
            rows[0].n,
            [r.least for r in rows],
            [(r.most - r.least).bit_length() for r in rows],
            [(r.high << LIMB) + r.low for r in rows],
        )
        for dim, rows in found.items()
    }


class Scatter:
    """Cross-products of shifted vectors of one length, from counts of ones in ANDed planes."""

    def __init__(self, stats: Stats):
        self.least = np.array(stats.least, np.int64)
        self.planes = [(i, p) for i, width in enumerate(stats.widths) for p in range(width)]
        self.counts = np.zeros((len(self.planes), len(self.planes)), np.int64)
        self.rows = 0

    def add(self, x: np.ndarray) -> None:
        """Adds up to `BLOCK` vectors."""
        shifted = (x - self.least).astype(np.uint64).T
        words = -(-len(x) // 64)
        sliced = np.zeros((len(self.planes), words * 8), np.uint8)
        for at, (i, p) in enumerate(self.planes):
            packed = np.packbits(((shifted[i] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8))
            sliced[at, : len(packed)] = packed
        sliced = sliced.view(np.uint64)
        for at in range(len(sliced)):
            ones = np.bitwise_count(sliced[at] & sliced[at:])
            self.counts[at, at:] += ones.sum(axis=1, dtype=np.int64)
        self.rows += len(x)

    def products(self):
        """(i, j, product) for i <= j, as integers of any size."""
        dims = np.array([i for i, _ in self.planes], np.int64)
        powers = np.array([1 << p for _, p in self.planes], object)
        whole = self.counts + np.triu(self.counts, 1).T
        starts = np.flatnonzero(np.diff(dims, prepend=-1))
        for i in dims[starts]:
            own = np.flatnonzero(dims == i)
            weighted = (whole[own].astype(object) * powers[own][:, None]).sum(axis=0) * powers
            for j, value in zip(dims[starts], np.add.reduceat(weighted, starts), strict=True):
                if j >= i:
                    yield int(i), int(j), int(value)


def _scatter(column: str, stats: dict[int, Stats]):
    def run(batches):
        found: dict[int, Scatter] = {}
        waiting: dict[int, list] = {}
        for batch in batches:
            for _, x in usable_vectors(batch, column):
                dim = x.shape[1]
                parts = waiting.setdefault(dim, [])
                parts.append(x)
                if sum(map(len, parts)) >= BLOCK:
                    x = np.concatenate(waiting.pop(dim))
                    full = len(x) - len(x) % BLOCK
                    scatter = found.setdefault(dim, Scatter(stats[dim]))
                    for at in range(0, full, BLOCK):
                        scatter.add(x[at : at + BLOCK])
                    waiting[dim] = [x[full:]]
        for dim, parts in waiting.items():
            scatter = found.setdefault(dim, Scatter(stats[dim]))
            scatter.add(np.concatenate(parts))
        for dim, scatter in found.items():
            rows = []
            for i, j, value in scatter.products():
                limb = 0
                while value:
                    rows.append((dim, i, j, limb, value & 0xFFFFFFFF))
                    value >>= LIMB
                    limb += 1
            if rows:
                yield _record(dict(zip(("dim", "i", "j", "limb", "value"), zip(*rows, strict=True), strict=True)))

    return run


def centred_products(df: DataFrame, column: str, stats: dict[int, Stats]) -> dict[int, list[list[int]]]:
    """Per length the covariance times n**2, as integers: n * products - sum * sum."""
    rows = df.select(column).mapInArrow(_scatter(column, stats), "dim int, i int, j int, limb int, value long")
    out = {dim: [[0] * dim for _ in range(dim)] for dim in stats}
    for r in rows.groupBy("dim", "i", "j", "limb").agg(F.sum("value").alias("value")).toLocalIterator():
        out[r.dim][r.i][r.j] += r.value << (LIMB * r.limb)
    for dim, products in out.items():
        own = stats[dim]
        shifted = [s - own.n * least for s, least in zip(own.sums, own.least, strict=True)]
        for i in range(dim):
            for j in range(i, dim):
                products[i][j] = products[j][i] = own.n * products[i][j] - shifted[i] * shifted[j]
    return out


def _rank(matrix: list[list[int]]) -> int:
    """Rank of an integer matrix, by elimination modulo a large prime."""
    rest = np.array([[v % PRIME for v in row] for row in matrix], np.int64)
    rank = 0
    for column in range(len(rest)):
        own = np.flatnonzero(rest[rank:, column])
        if not len(own):
            continue
        rest[[rank, rank + own[0]]] = rest[[rank + own[0], rank]]
        pivot = rest[rank] * pow(int(rest[rank, column]), -1, PRIME) % PRIME
        below = rest[rank + 1 :]
        rest[rank + 1 :] = (below - below[:, column : column + 1] * pivot % PRIME) % PRIME
        rank += 1
    return rank


def _jacobi(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors by plane rotations, which keep small eigenvalues of a graded
    matrix precise in themselves."""
    a, vectors = matrix.copy(), np.eye(len(matrix))
    for _ in range(60):
        turned = False
        for p in range(len(a) - 1):
            for q in range(p + 1, len(a)):
                if abs(a[p, q]) <= 1e-17 * np.sqrt(abs(a[p, p] * a[q, q])):
                    continue
                turned = True
                theta = (a[q, q] - a[p, p]) / (2 * a[p, q])
                t = (1.0 if theta >= 0 else -1.0) / (abs(theta) + np.hypot(theta, 1))
                c = 1 / np.hypot(t, 1)
                s = t * c
                low, high = a[p, p] - t * a[p, q], a[q, q] + t * a[p, q]
                for whole in (a.T, a, vectors.T):
                    x, y = whole[p].copy(), whole[q].copy()
                    whole[p], whole[q] = c * x - s * y, s * x + c * y
                a[p, p], a[q, q], a[p, q], a[q, p] = low, high, 0.0, 0.0
        if not turned:
            break
    return np.diag(a).copy(), vectors


@dataclass
class Basis:
    """Mean, leading components and eigenvalues of the vectors of one length."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def basis(stats: Stats, centred: list[list[int]], components: int = COMPONENTS) -> Basis:
    square = stats.n**2
    covariance = np.array([[v / square for v in row] for row in centred])
    k = min(components, len(centred))
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    rank = min(_rank(centred), k)
    if rank and values[order[rank - 1]] < GRADED * values[order[0]]:
        values, vectors = _jacobi(covariance)
        order = np.argsort(-values, kind="stable")
    order = order[:k]
    values = np.where(np.arange(k) < rank, values[order], 0.0)
    trace = sum(centred[i][i] for i in range(len(centred))) / square
    return Basis(stats.n, stats.sums, vectors[:, order], values, values / trace if trace else values)


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> dict[int, Basis]:
    """A basis per vector length. The driver holds numbers per pair of dimensions only."""
    stats = dimension_stats(df, column)
    centred = centred_products(df, column, stats)
    return {dim: basis(stats[dim], centred[dim], components) for dim in stats}


def _deviations(x: np.ndarray, own: Basis) -> tuple[np.ndarray, pa.Array]:
    """n * x - S, and the exact sums of its squares."""
    largest = own.n * float(np.abs(x).max()) + max(abs(s) for s in own.sums)
    exact = np.int64 if largest < 2**62 else object
    apart = x.astype(exact) * own.n - np.array(own.sums, exact)
    if exact is np.int64 and float(np.abs(apart).max()) ** 2 * x.shape[1] < 2**62:
        return apart, pa.array((apart**2).sum(axis=1)).cast(pa.decimal128(38, 0))
    squares = (apart.astype(object) ** 2).sum(axis=1)
    return apart, pa.array([Decimal(v) if v < 10**38 else None for v in squares.tolist()], pa.decimal128(38, 0))


def _projected(ids: str, column: str, model):
    def run(batches):
        for batch in batches:
            for rows, x in usable_vectors(batch, column):
                own = model.value[x.shape[1]]
                apart, deviation = _deviations(x, own)
                known = own.values > 0
                scale = np.sqrt(np.where(known, own.values, 1.0))
                whitened = (apart.astype(np.float64) / own.n) @ own.vectors / scale
                mask = np.broadcast_to(~known, whitened.shape).ravel()
                flat = pa.array(whitened.ravel(), mask=mask)
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(known))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(ids).take(pa.array(rows)),
                        pa.array(np.full(len(x), x.shape[1], np.int32)),
                        deviation,
                        pa.ListArray.from_arrays(ends, flat),
                    ],
                    ["id", "dim", "deviation", "whitened"],
                )

    return run


def _identity_errors(rows: DataFrame, model: dict[int, Basis]) -> dict[int, float]:
    """Per length, how far the covariance of the whitened vectors is from the identity. Two
    passes, as values are centred before they are multiplied."""
    most = max((int((b.values > 0).sum()) for b in model.values()), default=0)
    if not most:
        return {}
    cells = [F.get("whitened", F.lit(k)) for k in range(most)]
    means = {r.dim: r for r in rows.groupBy("dim").agg(*(F.avg(c).alias(f"m{k}") for k, c in enumerate(cells))).collect()}
    errors = {}
    for dim, own in model.items():
        k = int((own.values > 0).sum())
        if not k:
            continue
        mean = means[dim]
        pairs = [(a, b) for a in range(k) for b in range(a, k)]
        products = [F.avg((cells[a] - mean[f"m{a}"]) * (cells[b] - mean[f"m{b}"])) for a, b in pairs]
        found = rows.where(F.col("dim") == dim).agg(*products).first()
        errors[dim] = max(abs(v - (a == b)) for (a, b), v in zip(pairs, found, strict=True))
    return errors


def whiten(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row per usable
    vector and leading component.

    Vectors null, empty or with null, NaN or infinite entries take no part; repeated rows count
    and are returned as often as they occur; a null vec_id stays. Vectors of different lengths are
    fitted apart, each as a list of its own. `deviation` is decimal, null from 10**38 on. A component
    without variance (equal vectors, fewer vectors than dimensions) has explained 0 and whitened
    null, and no part in identity_error; without any other, that is null. Entries beyond
    2**61 after scaling are held there. An empty table gives no rows.
    """
    model = fit(df, embedding, components)
    kind = df.schema[vec_id].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = f"id {kind}, dim int, deviation decimal(38,0), whitened array<double>"
    source = df.select(F.col(vec_id).alias("id"), F.col(embedding).alias("vector"))
    rows = stored(source.mapInArrow(_projected("id", "vector", shared), schema), "whitened")
    errors = _identity_errors(rows, model)

    def per_length(values: dict, kind: str):
        found = [F.when(F.col("dim") == dim, F.lit(v).cast(kind)) for dim, v in values.items()]
        return F.coalesce(*found, F.lit(None).cast(kind))

    explained = {dim: F.array(*(F.lit(float(v)) for v in own.explained)) for dim, own in model.items()}
    return rows.select(
        F.col("id").alias(vec_id),
        "dim",
        "deviation",
        F.posexplode("whitened").alias("at", "whitened"),
        per_length(explained, "array<double>").alias("shares"),
    ).select(
        vec_id,
        (F.col("at") + 1).alias("component"),
        per_length({dim: own.n for dim, own in model.items()}, "long").alias("n"),
        "deviation",
        "whitened",
        F.get("shares", F.col("at")).alias("explained"),
        per_length(errors, "double").alias("identity_error"),
    )
