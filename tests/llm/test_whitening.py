"""Whitening against a dense solver on the whole table."""

import numpy as np
import pytest

from fleetlens.llm import whitening
from fleetlens.llm.common import table
from fleetlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id string, embedding array<float>, component int, key string, n string"


@pytest.mark.parametrize("d", [1, 2, 3, 7, 40])
def test_components_of_matrices(d):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    close = np.ones(d) + np.arange(d) // 3 * 1e-9
    some = rng.standard_normal((d, max(1, d // 4)))
    for m in (rng.standard_normal((d, d)), (q * close) @ q.T, np.eye(d), some @ some.T, np.diag(np.arange(d) + 1.0)):
        m = m @ m.T
        values, vectors = whitening.leading_components(m)
        want = np.linalg.eigvalsh(m)[::-1][:16]
        size = want[0]
        assert np.allclose(values, want, rtol=0, atol=1e-13 * size)
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
        assert np.allclose(m @ vectors, vectors * values, atol=1e-12 * size)


def plain(data):
    """Per (key, component): whitened value up to its sign, with exact sums in Python numbers."""
    grid = {k: [int(np.floor(64 * float(c))) + 1_000_000 for c in v] for k, v in data}
    fit = np.array(sorted({tuple(v) for v in grid.values()}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    x = np.array(fit - [s // n for s in sums], float) - np.array([float(s % n) / n for s in sums])
    v = x.T @ x / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    out = {}
    for key, g in grid.items():
        off = np.array([a - s // n for a, s in zip(g, sums)], float) - np.array([float(s % n) / n for s in sums])
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(g, sums))
        white = off @ vectors / np.sqrt(values)
        for i, w in enumerate(white):
            out[key, i + 1] = (n, deviation, w, values[i] / np.trace(v))
    return out


def same(got, want):
    assert {(r.vec_id, r.component) for r in got} == set(want)
    for r in got:
        n, deviation, white, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - abs(white)) < 1e-7 and abs(r.explained - share) < 1e-9
        assert r.identity_error < 1e-10
    signs = {}
    for r in got:
        white = want[r.vec_id, r.component][2]
        if abs(white) > 1e-6:
            assert signs.setdefault(r.component, r.whitened * white > 0) == (r.whitened * white > 0)


def test_the_query(spark):
    rows = table(spark, SF, "embeddings").collect()
    got = QUERIES["op11_whitening"](spark, SF).collect()
    same(got, plain([(r.vec_id, r.embedding) for r in rows]))
    # The whitened fit list itself has the identity as its covariance.
    white = {}
    for r in got:
        white.setdefault(r.vec_id, {})[r.component] = r.whitened
    x = np.unique(np.round([[w[c] for c in sorted(w)] for w in white.values()], 9), axis=0)
    assert np.abs(x.T @ x / len(x) - np.eye(x.shape[1])).max() < 1e-4


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    fine = [(f"v{i}", rng.standard_normal(20).tolist()) for i in range(60)]
    odd = [("null", None), ("part", [None, *[1.0] * 19]), ("nan", [float("nan")] * 20), ("inf", [float("inf")] * 20),
           ("short", [1.0]), ("empty", [])]
    fine += [("far", [300.0, *[0.0] * 19]), ("again", fine[0][1]), (None, fine[1][1])]
    frame = spark.createDataFrame([(k, v, 1, "k", "n") for k, v in [*fine, *odd]], VECTORS).repartition(5)
    as_float = [(k, np.array(v, np.float32).tolist()) for k, v in fine]
    same(whitening.whiten(frame).collect(), plain(as_float))
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.whiten(frame.where("vec_id = 'v1'")).count() == 0
    # Two vectors differ in one direction only.
    assert {r.component for r in whitening.whiten(frame.where("vec_id in ('v1', 'v2')")).collect()} == {1}


def test_deviations_beyond_machine_numbers():
    x = np.array([[1 << 40, 0], [-(1 << 40), 5]], dtype=np.int64)
    n, sums = 1 << 30, [7, 1 << 50]
    want = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert whitening._deviations(x, n, sums) == [v if v < 1 << 63 else None for v in want]
    assert whitening._deviations(x, 1, sums) == [
        v if (v := sum((int(a) - s) ** 2 for a, s in zip(row, sums))) < 1 << 63 else None for row in x
    ]
