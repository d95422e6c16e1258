import math
import os

import numpy as np
import pytest

from tallymart.llm import whiten
from tallymart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, n long, component int, whitened double"


def frame_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(v), 1, 2, 3.0) for i, v in rows], SCHEMA).repartition(3)


def exact(rows):
    """Usable ids, whole-number matrix, exact deviations, covariance."""
    used = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in used), default=0)
    x = [[math.floor(1024 * c) + 100_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in used]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    moved = [[n * a - s for a, s in zip(row, sums)] for row in x]
    c = np.array([[m / n for m in row] for row in moved]).reshape(n, width)
    return [i for i, _ in used], [sum(m * m for m in row) for row in moved], c, c.T @ c / max(n, 1)


def same_axes(got, want, tolerance):
    """Columns equal up to sign."""
    sign = np.sign((got * want).sum(axis=0))
    return np.abs(got * sign - want).max() <= tolerance * np.abs(want).max()


def compared(spark, rows, components=8, tolerance=1e-8):
    ids, deviations, c, cov = exact(rows)
    out, model, error = whiten.whiten(frame_of(spark, rows), components=components)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    kept = values > 1e-12 * values[0]
    assert model.n == len(ids) and np.allclose(model.values, values[kept], rtol=1e-10)
    assert abs(model.trace - np.trace(cov)) <= 1e-10 * np.trace(cov) and error <= 1e-8
    got = sorted((r["id"] is None, r["id"] or 0, r["deviation"], r["whitened"]) for r in out.collect())
    assert sorted((i is None, i or 0, d) for i, d in zip(ids, deviations)) == [g[:3] for g in got]
    if len(set(ids)) == len(ids) and None not in ids:
        at = {i: p for p, i in enumerate(ids)}
        w = np.array([g[3] for g in sorted(got, key=lambda g: at[g[1]])])
        assert same_axes(w, c @ (axes[:, kept] / np.sqrt(values[kept])), tolerance)
    return model


def test_a_falling_spectrum(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 40)) * 0.9 ** np.arange(40) @ np.linalg.qr(rng.normal(size=(40, 40)))[0]
    model = compared(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    assert model.residuals.max() <= 1e-11 * model.values[0] and model.passes > 10


def test_a_nearly_flat_spectrum(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    compared(spark, [(i, v.tolist()) for i, v in enumerate(x)], tolerance=1e-7)


def test_equal_eigenvalues_are_whitened_too(spark):
    corners = np.array(np.meshgrid(*[[-1.0, 1.0]] * 6)).reshape(6, -1).T
    rows = [(i, v.tolist()) for i, v in enumerate(np.repeat(corners, 3, axis=0))]
    out, model, error = whiten.whiten(frame_of(spark, rows), components=4)
    assert np.allclose(model.values, model.values[0]) and error <= 1e-10 and out.count() == len(rows)


def test_more_dimensions_than_the_block_and_less_rank(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 50)) * 50
    model = compared(spark, [(i, np.round(v * 4).tolist()) for i, v in enumerate(x)], components=3)
    assert model.values.size == 3
    rows = [(i, [float(i % 7), 2.0 * (i % 7), 1.0]) for i in range(70)]
    assert compared(spark, rows).values.size == 1


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    rows += [(None, [1.0, 2.0]), (70, None), (71, [1.0, None]), (72, [float("nan")]), (73, [float("inf"), 1.0]), (74, []),
             (5, [1.0, 2.0, 3.0, 4.0, 5.0]), (5, [1.0, 2.0, 3.0, 4.0, 5.0]), (None, None)]
    compared(spark, rows)


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(0, [1e9, 0.0]), (1, [-1e9, 0.0]), (2, [0.0, 1.0])]
    out = {r["id"]: r["deviation"] for r in whiten.whiten(frame_of(spark, rows))[0].collect()}
    assert out[0] is None and out[1] is None and out[2] == exact(rows)[1][2]


def test_no_rows_one_row_and_equal_rows(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [0.5, 0.25]) for i in range(20)]):
        out, model, error = whiten.whiten(frame_of(spark, rows))
        usable = [r for r in rows if r[1] is not None]
        got = out.collect()
        assert len(got) == len(usable) and all(r["whitened"] == [] for r in got)
        assert model.n == len(usable) and model.values.size == 0 and error == 0.0


def test_an_uncertified_iteration_raises(spark, monkeypatch):
    monkeypatch.setattr(whiten, "ROUNDS", 1)
    rng = np.random.default_rng(4)
    chunks = whiten.chunks_of(frame_of(spark, [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 40)))]), "vec_id", "embedding")
    with pytest.raises(ArithmeticError):
        whiten.fit(chunks)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_op13_equals_a_full_decomposition(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    ids, deviations, c, cov = exact(rows)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    got = sorted(QUERIES["op13_whiten"](spark, SF).collect(), key=lambda r: (r["vec_id"], r["component"]))
    assert len(got) == 8 * len(ids) and [r["component"] for r in got[:8]] == list(range(1, 9))
    at = {i: p for p, i in enumerate(ids)}
    assert all(r["deviation"] == deviations[at[r["vec_id"]]] and r["n"] == len(ids) for r in got)
    assert max(r["identity_error"] for r in got) <= 1e-8
    assert np.allclose([r["explained"] for r in got[:8]], values / np.trace(cov), rtol=1e-10)
    w = np.array([r["whitened"] for r in got]).reshape(-1, 8)
    assert same_axes(w, (c @ (axes / np.sqrt(values)))[[at[r["vec_id"]] for r in got[::8]]], 1e-8)
