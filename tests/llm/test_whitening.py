import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string"


def vectors(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA).repartition(parts)


def brute(rows):
    """n, exact deviations, eigenvalues and components from exact integers."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    sums = [sum(x[j] for _, x in kept) for j in range(d)]
    far = {i: sum((n * x[j] - sums[j]) ** 2 for j in range(d)) for i, x in kept}
    cov = np.array([[float(Fraction(sum((n * x[a] - sums[a]) * (n * x[b] - sums[b]) for _, x in kept), n ** 3))
                     for b in range(d)] for a in range(d)])
    values, vecs = np.linalg.eigh(cov)
    centred = {i: np.array([float(Fraction(n * x[j] - sums[j], n)) for j in range(d)]) for i, x in kept}
    return n, far, values[::-1], vecs[:, ::-1].T, centred


@pytest.fixture
def mixed():
    r = np.random.default_rng(5)
    base = r.normal(size=(60, 12)) @ r.normal(size=(12, 12)) * np.linspace(3, 0.05, 12) + 7
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (90, None), (91, [None] + rows[1][1][1:]),
             (92, [float("nan")] + rows[1][1][1:]), (93, [float("inf")] + rows[1][1][1:])]
    return rows


def test_equals_brute_force(spark, mixed):
    got = whitening.whitened_components(vectors(spark, mixed)).collect()
    n, far, values, components, centred = brute(mixed)
    assert n == 62 and len(got) == 62 * 8 and {r.n for r in got} == {62}
    assert all(r.deviation == far[r.vec_id] for r in got)
    assert {r.component for r in got} == set(range(1, 9))
    signs = {}
    for r in got:
        c = r.component - 1
        assert r.explained == pytest.approx(values[c] / values.sum(), rel=1e-10)
        want = centred[r.vec_id] @ components[c] / math.sqrt(values[c])
        sign = signs.setdefault(c, math.copysign(1, want * r.whitened) if abs(want) > 1e-6 else None) or 1
        assert r.whitened * sign == pytest.approx(want, abs=1e-8)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_partitioning_does_not_matter(spark, mixed):
    def run(parts):
        rows = whitening.usable(vectors(spark, mixed, parts), "vec_id", "embedding")
        m = whitening.fit(rows)
        return m.n, m.centre, m.rest, m.values.tolist(), m.components.tolist()

    assert run(1) == run(7)


def test_large_entries_stay_exact(spark):
    rows = [(0, [3e12, 1.0]), (1, [-3e12, 2.0]), (2, [1e12, 5.0]), (3, [1e30, 0.0]), (4, [1.0])]
    model = whitening.fit(whitening.usable(vectors(spark, rows), "vec_id", "embedding"))
    assert model.n == 3  # 1e30 is no long, and one entry is not two
    x = [[math.floor(1024 * float(np.float32(c))) for c in v] for _, v in rows[:3]]
    far = [sum((3 * p[j] - sum(q[j] for q in x)) ** 2 for j in range(2)) for p in x]
    assert model.deviations(np.array(x)) == far and far[0] > 1 << 63
    got = whitening.whitened_components(vectors(spark, rows)).collect()
    assert {r.deviation for r in got} == {None if f >= 1 << 63 else f for f in far}


def test_low_rank(spark):
    rows = [(i, [float(i), 2.0 * i, 1.0, 0.0]) for i in range(9)]
    got = whitening.whitened_components(vectors(spark, rows)).collect()
    assert {r.component for r in got} == {1} and len(got) == 9
    assert got[0].explained == pytest.approx(1.0)
    assert np.var([r.whitened for r in got]) == pytest.approx(1.0)


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [])], [(0, [1.0, 2.0])], [(0, [1.0]), (0, [1.0])]])
def test_nothing_to_whiten(spark, rows):
    df = whitening.whitened_components(vectors(spark, rows, 2) if rows else spark.createDataFrame([], SCHEMA))
    assert df.count() == 0
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_moments_merge_in_groups(spark, mixed):
    rows = whitening.usable(vectors(spark, mixed, 9), "vec_id", "embedding")
    model = whitening.fit(rows)
    errors = [whitening.identity_error(rows, model, 8, groups) for groups in (1, 2, 16)]
    assert max(errors) < 1e-9 and errors[0] == pytest.approx(errors[2], abs=1e-12)


def test_factor_and_rotation():
    r = np.random.default_rng(1)
    x = r.normal(size=(40, 7)) * [1e2, 10, 1, 1, 0.5, 0.1, 0]
    a = x.T @ x
    factor = whitening.pivoted_cholesky(a)
    assert factor.shape == (7, 6) and np.allclose(factor @ factor.T, a, rtol=1e-12)
    turned = whitening.one_sided_jacobi(factor)
    norms = np.sort((turned ** 2).sum(0))[::-1]
    assert np.allclose(norms, np.linalg.svd(x, compute_uv=False)[:6] ** 2, rtol=1e-8)
    unit = turned / np.sqrt((turned ** 2).sum(0))
    assert np.abs(unit.T @ unit - np.eye(6)).max() < 1e-13
