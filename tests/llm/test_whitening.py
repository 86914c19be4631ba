import numpy as np
import pytest
from conftest import SF

from tripledger.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(vectors, wanted=4):
    """n, sums, covariance, eigenvalues and whitened rows of lists of entries, by the library's eigensolver."""
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for v in vectors])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:wanted], v[:, ::-1][:, :wanted]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, (x - sums / n) @ v / np.sqrt(e), e / np.trace(cov)


def held(df, vectors, ids):
    got = {}
    for r in df.collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    n, deviation, whitened, explained = brute(vectors)
    assert sorted(got) == sorted(ids)
    signs = {}
    for i, vec_id in enumerate(ids):
        rows = got[vec_id]
        assert sorted(rows) == list(range(1, len(explained) + 1))
        for k, r in rows.items():
            assert (r.n, r.deviation) == (n, deviation[i])
            assert r.explained == pytest.approx(explained[k - 1], rel=1e-9) and r.identity_error < 1e-9
            want = whitened[i, k - 1]
            if abs(want) > 1e-3:
                assert signs.setdefault(k, np.sign(r.whitened * want)) == np.sign(r.whitened * want)
            assert abs(r.whitened) == pytest.approx(abs(want), rel=1e-7, abs=1e-7)


def test_given_table_beside_the_eigensolver(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [r for r in df.collect() if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    held(whitening.whiten(df), [r.embedding for r in rows], [r.vec_id for r in rows])


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(60, 3)) * [3, 1, 0.2]).astype(np.float32).tolist()
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(100 + i, v, 0) for i, v in enumerate(vectors[:20])] + [(200, vectors[0], 0)] * 1
    bad = [(300, None, 0), (301, [1.0, None, 2.0], 0), (302, [1.0, float("nan"), 2.0], 0), (303, [float("-inf"), 1.0, 1.0], 0), (304, [], 0), (305, [1.0], 0)]
    df = spark.createDataFrame(rows + bad, VECTORS).repartition(7)
    held(whitening.whiten(df), [r[1] for r in rows], [r[0] for r in rows])


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)], [(1, [], 0)]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect() == []


def test_clashing_and_extra_columns_huge_entries_null_ids(spark):
    rows = [(None, [1e30, 0.0], "a", 1), (2, [0.5, -0.0], "b", 2), (3, [-1e30, -0.001], "c", 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, component int")
    got = whitening.whiten(df).collect()
    assert {r.vec_id for r in got} == {None, 2, 3} and all(np.isfinite(r.whitened) for r in got)
    assert all(r.deviation is None for r in got if r.vec_id != 2)


@pytest.mark.parametrize("size", [1, 2, 5, 64, 200])
def test_divide_and_conquer_finds_the_greatest(size):
    rng = np.random.default_rng(size)
    q, _ = np.linalg.qr(rng.normal(size=(size, size)))
    for values in (rng.random(size), 2.0 ** -np.arange(size), np.r_[np.full(size // 2, 3.0), np.arange(1, size - size // 2 + 1)], np.ones(size)):
        a = q * values @ q.T
        a = (a + a.T) / 2
        e, v = whitening.leading_components(a, 4)
        want = np.sort(values)[::-1][:4]
        assert np.allclose(e, want, rtol=1e-12, atol=1e-13)
        assert np.allclose(v.T @ v, np.eye(len(e)), atol=1e-13)
        assert np.linalg.norm(a @ v - v * e) < 1e-12


def test_polar_factor_takes_signs():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    values = np.r_[-np.logspace(0, -9, 12), np.logspace(-9, 2, 18)]
    a = q * values @ q.T
    assert np.allclose(whitening.polar_factor((a + a.T) / 2), q * np.sign(values) @ q.T, atol=1e-6)
