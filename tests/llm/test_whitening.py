"""Whitening against a dense decomposition: graded, repeated, close and missing variances, rows that don't count."""

import numpy as np
import pytest

from comarca.llm import entries, whitening
from entries.tables import table

SF = "/root/testdata/sf0.001"


def solved(rows):
    centred = rows - rows.mean(axis=0)
    d = rows.shape[1]
    r = np.linalg.qr(np.vstack([centred, np.zeros((d, d))]), mode="r")[:d]
    return centred, whitening.principal(r, whitening.Centre(len(rows), [0] * d))


def spectra():
    rng = np.random.default_rng(0)
    base = rng.standard_normal((600, 40))
    even = np.linalg.qr(rng.standard_normal((300, 40)))[0]
    even = np.vstack([even, -even])
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    fallen = base.copy()
    fallen[:, 3], fallen[:, 7] = 5.0, fallen[:, 8]
    return {
        "random": base, "graded": base * 10.0 ** np.linspace(0, -6, 40), "turned": base @ rng.standard_normal((40, 40)),
        "equal": even, "two values": even * np.where(np.arange(40) < 15, 2, 1), "chain": even * (1 + 1e-5 * np.arange(40)),
        "groups": even @ np.diag(np.repeat(2.0 ** -np.arange(10), 4)) @ turn, "no variance in some": fallen,
        "unit rows": np.repeat(np.eye(8), 10, axis=0), "few rows": base[:5], "one column": base[:, :1], "two columns": base[:, :2],
    }


@pytest.mark.parametrize("name", spectra())
def test_directions_and_variances(name):
    centred, found = solved(spectra()[name])
    n, d = centred.shape
    want = np.zeros(d)
    singular = np.linalg.svd(centred, compute_uv=False)
    want[: len(singular)] = singular**2 / n
    live = found.live()
    assert live.sum() == (want > want.max() * 1e-20).sum() and np.allclose(found.variances[live], want[live], rtol=1e-11)
    covariance = centred.T @ centred / n
    assert np.abs(covariance @ found.directions - found.directions * found.variances).max() <= 1e-13 * want[0]
    assert np.abs(found.directions.T @ found.directions - np.eye(d)).max() < 1e-9
    white = found.whitened(centred, d)[:, live]
    assert np.abs(white.T @ white / n - np.eye(live.sum())).max() < 1e-8


def test_dqds_keeps_the_digits_of_small_values():
    diagonal, above = 10.0 ** -np.arange(0, 30, 2), np.full(14, 1e-9) * 10.0 ** -np.arange(0, 28, 2)
    got = whitening.squared_values(diagonal, above)
    from fractions import Fraction

    # The product of all values is the determinant, exact in fractions.
    want = np.prod([Fraction(x) for x in diagonal]) ** 2
    product = np.prod([Fraction(float(x)) for x in got])
    assert abs(product / want - 1) < 1e-13 and len(got) == 15 and (np.diff(got) < 0).all()


def test_nothing_varies():
    for rows in (np.ones((6, 3)), np.zeros((1, 4))):
        _, found = solved(rows)
        assert not found.live().any() and (found.explained() == 0).all()


def plain(rows, components=32):
    """By definition, from the covariance."""
    x = np.floor(64 * rows).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums).astype(object) ** 2).sum(axis=1)
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return n, deviation, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def compared(got, ids, rows):
    n, deviation, white, explained = plain(rows)
    got = got.toPandas().sort_values(["component", "vec_id"])
    k = white.shape[1]
    assert len(got) == len(ids) * k and (got["n"] == n).all()
    order = np.argsort(ids)
    mine = got["whitened"].to_numpy().reshape(k, -1).T
    signs = np.sign((mine * white[order]).sum(axis=0))
    assert np.abs(mine - white[order] * signs).max() < 1e-7
    assert np.allclose(got["explained"].to_numpy().reshape(k, -1), explained[:, None], rtol=1e-9)
    assert (got["deviation"].to_numpy().reshape(k, -1) == deviation[order].astype(np.int64)).all()
    assert got["identity_error"].nunique() == 1 and 0 <= got["identity_error"].iloc[0] < 1e-9


def test_rows_that_do_not_count(spark):
    rng = np.random.default_rng(1)
    rows = np.round(rng.standard_normal((200, 5)), 2) + [0, 0, 1000, -3, 0]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [nan] * 5, [inf, 0.0, 0.0, 0.0, 0.0], [1e30, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    given = [((1 << 60) + i, r.tolist(), 1, "x") for i, r in enumerate(rows)] + [(i, b, 2, "y") for i, b in enumerate(bad)]
    vectors = spark.createDataFrame(given, "vec_id long, embedding array<double>, n int, c string").repartition(4)
    got = whitening.whiten(vectors)
    assert got.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
        ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
    ]
    compared(got, [g[0] for g in given[:200]], rows)
    none = whitening.whiten(vectors.where("embedding IS NULL"))
    assert none.count() == 0 and none.dtypes == got.dtypes


def test_no_variance_and_large_entries(spark):
    same = spark.createDataFrame([(None, [1.0, 2.0])] * 9 + [(7, [1.0, 2.0])], "vec_id long, embedding array<double>")
    rows = whitening.whiten(same).collect()
    assert len(rows) == 20 and all((r.whitened, r.explained, r.identity_error, r.deviation) == (None, 0.0, None, 0) for r in rows)
    # n x - S beyond a long, and its squares.
    large = spark.createDataFrame([(i, [float(i % 3) * 2.0**54, 1.0]) for i in range(300)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(large).where("component = 1").collect()
    assert {round(abs(r.whitened), 9) for r in rows} == {round(1.5**0.5, 9), 0.0}
    assert {(r.vec_id % 3, r.deviation) for r in rows} == {(0, None), (1, 0), (2, None)}
    some = spark.createDataFrame([(i, [float(i % 3) * 2.0**20]) for i in range(33)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(some).collect()
    assert {(r.vec_id % 3, r.deviation) for r in rows} == {(0, (33 << 26) ** 2), (1, 0), (2, (33 << 26) ** 2)}


def test_triangles_of_many_tasks_and_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((700, 6)) * [1, 10, 100, 1, 1, 0.5]
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    monkeypatch.setattr(whitening, "MERGERS", 3)
    vectors = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id int, embedding array<double>")
    compared(whitening.whiten(vectors.repartition(40)), list(range(700)), rows)


def test_query(spark):
    given = table(spark, SF, "embeddings").collect()
    rows = [(r.vec_id, r.embedding) for r in given if r.embedding and np.isfinite(np.array(r.embedding, dtype=float)).all()]
    got = entries.QUERIES["op12_qd_whitening"](spark, SF)
    compared(got, [i for i, _ in rows], np.array([v for _, v in rows], dtype=float))
