"""Whitening against numpy over all rows."""

import numpy as np
import pytest

from sheetloom.llm import whitening as W


def plain(vectors, components, by_count=True):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    fit = x if by_count else np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    return n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ axes[:, :components] / np.sqrt(e[:components]), e[:components] / e.sum()


@pytest.mark.parametrize("hot,by_count", [(2_048, True), (4, True), (4, False)])
def test_like_numpy(spark, hot, by_count):
    rng = np.random.default_rng(4)
    kinds = rng.normal(0, [3, 2, 1, 0.5, 0.1], (60, 5))
    vectors = np.concatenate([kinds, kinds[rng.integers(0, 20, 100)], np.repeat(kinds[:1], 80, axis=0)])
    df = spark.createDataFrame([(i if i != 7 else None, v.tolist(), "a", 1, 2.0) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<double>, id string, component int, whitened double")
    rows = W.whiten(df, components=3, by_count=by_count, hot=hot).collect()
    n, deviations, whitened, explained = plain(vectors, 3, by_count)
    got = {(r["id"], r["component"]): r for r in rows}
    assert len(rows) == len(got) == 3 * len(vectors)
    signs = [np.sign(got[0, k + 1]["whitened"] * whitened[0, k]) for k in range(3)]
    for i in range(len(vectors)):
        for k in range(3):
            r = got[i if i != 7 else None, k + 1]
            assert (r["n"], int(r["deviation"])) == (n, deviations[i])
            assert abs(signs[k] * r["whitened"] - whitened[i, k]) < 1e-9 and abs(r["explained"] - explained[k]) < 1e-12
            assert r["identity_error"] < 1e-9


def test_odd_vectors(spark):
    rows = [(1, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [1.0, 2.0]), (3, None), (4, []), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [float("inf"), 1.0]),
            (8, [1.0, 2.0, 3.0]), (9, [1e300, -1e300, 5.0]), (10, [7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = W.whiten(df).collect()
    # every length by itself; a component without variance is null
    assert sorted((r["id"], r["component"], r["n"], r["whitened"] is None) for r in got) == sorted(
        [(1, 1, 3, False), (1, 2, 3, True)] * 2 + [(2, 1, 3, False), (2, 2, 3, True)]
        + [(i, k, 2, k > 1) for i in (8, 9) for k in (1, 2, 3)] + [(10, 1, 1, True)])
    assert {int(r["deviation"]) for r in got if r["id"] == 10} == {0}
    assert all(r["identity_error"] < 1e-9 for r in got)
    assert W.whiten(df.limit(0)).count() == 0
    x, centre = [2 ** 62 + W.SHIFT, -2 ** 62 + W.SHIFT, 5 * 1024 + W.SHIFT], [0.0] * 3
    fit = W.Fit(3, [5, 7, 11], np.zeros((0, 3)), np.zeros(0), 0.0)
    assert fit.deviations(np.array([x]))[0] is None or int(fit.deviations(np.array([x]))[0]) == sum((3 * v - s) ** 2 for v, s in zip(x, fit.sums, strict=True))
    assert len(centre) == fit.centred(np.array([x])).shape[1]
