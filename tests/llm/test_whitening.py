"""Whitening against plain integer and matrix arithmetic."""

from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import whitening
from panelcast.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"


def whole(vectors):
    return [[int(np.floor(1024 * float(v))) + 100_000 for v in row] for row in vectors]


def check(rows, x, directions, components=8):
    """`rows` by (vec_id, component) for vectors `x` by vec_id, of one length and full rank.
    `directions` are the unit vectors of the fit."""
    n, dim = len(x), len(next(iter(x.values())))
    sums = [sum(v[j] for v in x.values()) for j in range(dim)]
    apart = {k: [n * a - s for a, s in zip(v, sums)] for k, v in x.items()}
    trace = sum(Fraction(a * a, n**3) for v in apart.values() for a in v)
    found = {}
    for r in rows:
        found.setdefault(r.vec_id, {})[r.component] = r
    assert set(found) == set(x) and all(set(v) == set(range(1, min(components, dim) + 1)) for v in found.values())
    centred = np.array([[a / n for a in apart[k]] for k in x])
    covariance = centred.T @ centred / n
    for k, own in found.items():
        assert own[1].n == n and own[1].deviation == sum(a * a for a in apart[k])
    for c in range(1, min(components, dim) + 1):
        values = np.array([found[k][c].whitened for k in x])
        assert abs(values.mean()) < 1e-6 and abs((values**2).mean() - 1) < 1e-4
        assert found[next(iter(x))][c].identity_error < 1e-4
        e = found[next(iter(x))][c].explained * float(trace)
        direction = directions[:, c - 1]
        assert abs(np.linalg.norm(direction) - 1) < 1e-12
        assert (np.abs(covariance @ direction - e * direction) <= 1e-9 * (np.abs(covariance) @ np.abs(direction))).all()
        projected = centred @ direction / np.sqrt(e)
        assert np.allclose(values, projected, rtol=1e-6, atol=1e-6)
    shares = [found[next(iter(x))][c].explained for c in sorted(found[next(iter(x))])]
    assert shares == sorted(shares, reverse=True)


def test_op11(spark):
    table = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_DIR}/embeddings.parquet'").fetchall()
    vectors = dict(zip([r[0] for r in table], whole(r[1] for r in table)))
    directions = whitening.fit(spark.read.parquet(f"{SF_DIR}/embeddings.parquet"))[64].vectors
    check(QUERIES["op11_embedding_whitening"](spark, SF_DIR).collect(), vectors, directions)


def test_scatter_is_exact():
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(-5, 6, 1000), rng.integers(0, 2**40, 1000), np.full(1000, 7), rng.integers(-(2**59), 2**59, 1000)])
    stats = whitening.Stats(1000, x.min(0).tolist(), [int(a).bit_length() for a in (x.max(0) - x.min(0)).tolist()], [])
    scatter = whitening.Scatter(stats)
    scatter.add(x[:900])
    scatter.add(x[900:])
    shifted = (x - x.min(0)).astype(object)
    products = shifted.T @ shifted
    assert {(i, j): v for i, j, v in scatter.products()} == {(i, j): products[i, j] for i in (0, 1, 3) for j in (0, 1, 3) if i <= j}


@pytest.mark.parametrize("scale", [1.0, 1e9])
def test_any_scale(spark, scale):
    """Dimensions of very different sizes keep their precision."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(v) for v in rng.normal(size=5) * [scale, 1, 3, 1, 2] + 40]) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    check(whitening.whiten(df).collect(), {i: whole([v])[0] for i, v in rows}, whitening.fit(df)[5].vectors)


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(40)]
    odd = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [float("nan"), 0.0, 0.0]), (54, [float("inf"), 0.0, 0.0])]
    lengths = [(60, [1.0, 2.0]), (61, [1.0, 2.0]), (62, [3.0])]
    repeated = [(7, good[7][1]), (None, good[8][1])]
    df = spark.createDataFrame(good + odd + lengths + repeated, SCHEMA).repartition(4)
    df = df.select("*", *(F.lit("own").alias(c) for c in ("dim", "id", "n", "whitened", "component", "i")))
    found = whitening.whiten(df).collect()
    three = [r for r in found if r.n == 42]
    assert len(three) == 42 * 3
    assert sorted(r.component for r in three if r.vec_id == 7) == [1, 1, 2, 2, 3, 3]
    assert sorted(r.component for r in three if r.vec_id is None) == [1, 2, 3]
    # Equal vectors have no component with variance.
    equal = [r for r in found if r.vec_id in (60, 61, 62)]
    assert sorted((r.vec_id, r.component, r.n) for r in equal) == [(60, 1, 2), (60, 2, 2), (61, 1, 2), (61, 2, 2), (62, 1, 1)]
    assert {(r.whitened, r.explained, int(r.deviation), r.identity_error) for r in equal} == {(None, 0.0, 0, None)}
    assert not {r.vec_id for r in found} & {50, 51, 52, 53, 54}
    empty = whitening.whiten(df.where("false"))
    assert empty.columns == whitening.whiten(df).columns and empty.count() == 0


def test_fewer_vectors_than_dimensions(spark):
    rows = [(1, [0.0, 1.0, 5.0, 0.25]), (2, [2.0, 1.0, 5.0, 0.5]), (3, [0.0, 3.0, 5.0, 0.125])]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component: r.whitened is None for r in found} == {1: False, 2: False, 3: True, 4: True}
    assert all(r.identity_error < 1e-9 for r in found)


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(10**12 * i), float(i * i)]) for i in range(50)]
    x = {i: whole([v])[0] for i, v in rows}
    sums = [sum(v[j] for v in x.values()) for j in (0, 1)]
    found = {r.vec_id: int(r.deviation) for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {i: sum((50 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    assert max(found.values()) > 2**63
