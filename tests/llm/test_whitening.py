"""Whitening: refined eigenvectors against extended precision, rows against plain numpy, awkward rows."""

import numpy as np
import pytest
from conftest_llm import SMALL
from pyspark.sql import functions as F

from balcao.llm import queries, whitening
from balcao.llm.tables import given


def orthogonal(d, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q + q @ (np.eye(d) - q.T @ q) / 2
    return q


SPECTRA = {
    "apart": np.linspace(1, 4, 48),
    "cluster": 1 + 1e-9 * np.arange(48),
    "two clusters": np.r_[1 + 1e-8 * np.arange(24), 1e2 + 1e-6 * np.arange(24)],
    "graded": np.logspace(0, -12, 48),
    "repeated": np.repeat([1.0, 2.0, 5.0], 16),
    "low rank": np.r_[np.zeros(40), np.arange(1, 9)],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_refined_eigenvectors(name):
    values = SPECTRA[name].astype(np.longdouble)
    q = orthogonal(len(values))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.refined(a)
    order = np.argsort(-values, kind="stable")
    top = float(values.max())
    assert np.abs(found - values[order]).max() < 1e-17 * top
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-15 * top
    if len(set(values)) == len(values):
        assert np.abs(np.abs((x * q[:, order]).sum(axis=0)) - 1).max() < 1e-13
    # Plain double precision does worse where eigenvalues are close.
    if name == "cluster":
        plain = np.linalg.eigh(a.astype(np.float64))[1][:, ::-1]
        assert np.abs(plain - x * np.sign((plain * x).sum(axis=0))).max() > 1e-9


def brute(ids, vectors, components=32):
    """(id, component) -> (deviation, whitened, explained), signs as found."""
    x = np.floor(64 * np.asarray(vectors, np.float64)) + 1_000_000
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    values, u = np.linalg.eigh(np.cov(x.T, bias=True).reshape(len(sums), -1))
    values, u = values[::-1], u[:, ::-1]
    z = (x - x.mean(axis=0)) @ u / np.sqrt(values)
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return deviation, z[:, :components], values / values.sum()


def pivoted(rows, ids):
    return rows.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()


def test_query_equals_numpy(spark):
    given_rows = given(spark, SMALL, "embeddings").toPandas()
    rows = queries.op12_whiten(spark, SMALL).toPandas()
    deviation, z, explained = brute(given_rows.vec_id, np.stack(given_rows.embedding))
    assert len(rows) == len(given_rows) * 32
    found = pivoted(rows, given_rows.vec_id)
    assert np.abs(found * np.sign((found * z).sum(axis=0)) - z).max() < 1e-9
    assert rows.groupby("vec_id").deviation.first().loc[given_rows.vec_id].tolist() == deviation
    assert rows.groupby("component").explained.first().to_numpy() == pytest.approx(explained[:32], rel=1e-9)
    assert set(rows.n) == {len(given_rows)} and 0 <= rows.identity_error[0] < 1e-12


SCHEMA = "vec_id bigint, vector array<float>, component int, n string, place int, s double, dim int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 2, 3.0, 4) for r in rows], SCHEMA)


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(v) for v in np.float32(rng.normal(size=5))]) for i in range(60)]
    good += [(1, good[1][1]), (None, good[2][1]), (99, [0.0] * 5)]
    bad = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [float("nan")] + [0.0] * 4),
           (204, [float("inf")] + [0.0] * 4), (205, [1e30] + [0.0] * 4), (206, [1.0, 2.0])]
    rows = whitening.whitened(table(spark, good + bad).repartition(7)).toPandas()
    deviation, z, explained = brute([r[0] for r in good], [r[1] for r in good])
    assert len(rows) == len(good) * 5 and set(rows.vec_id.dropna()) == {r[0] for r in good if r[0] is not None}
    once = [i for i, r in enumerate(good) if r[0] not in (1, None)]
    found = pivoted(rows[rows.vec_id.notna() & (rows.vec_id != 1)], [good[i][0] for i in once])
    assert np.abs(found * np.sign((found * z[once]).sum(axis=0)) - z[once]).max() < 1e-9
    assert sorted(rows.groupby(["vec_id", "component"], dropna=False).size()) == [1] * (61 * 5) + [2] * 5
    assert set(rows.deviation) == set(deviation)
    again = whitening.whitened(table(spark, good).coalesce(1)).toPandas()
    assert rows.explained.unique().tolist() == again.explained.unique().tolist()  # however rows are spread


def test_large_entries_stay_exact(spark):
    values = [[1e9, 0.0], [-1e9, 1.0], [3e8, 0.5], [1e13, 2.0]]
    rows = whitening.whitened(table(spark, list(enumerate(values)))).toPandas()
    x = [[int(np.floor(64 * np.float64(np.float32(v)))) + 1_000_000 for v in row] for row in values]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = [sum((4 * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    got = rows.groupby("vec_id").deviation.first().tolist()
    assert [w if w < 1 << 63 else None for w in want] == [None if np.isnan(g) else g for g in got]
    assert rows.identity_error[0] < 1e-6


def test_without_spread_and_without_rows(spark):
    same = whitening.whitened(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert len(same) == 4 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(0, None, None, None)}
    line = whitening.whitened(table(spark, [(i, [i / 64, 7.0]) for i in range(3)])).collect()
    assert {(r.component, r.whitened is None, r.explained) for r in line} == {(1, False, 1.0), (2, True, 0.0)}
    assert whitening.whitened(table(spark, [])).collect() == []
    assert whitening.whitened(table(spark, [(1, None)])).filter(F.lit(True)).collect() == []
