from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nightframe.llm import whitening
from nightframe.llm.registry import op12_whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, most=32):
    """Everything by numpy's own eigenvalues and Python's whole numbers."""
    kept = [(i, [float(c) for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v] for _, v in kept])
    n, sums = len(x), [sum(c) for c in x.T.tolist()]
    centred = x - np.array([s / n for s in sums])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x.tolist()]
    return [i for i, _ in kept], n, deviation, centred @ u / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def check(found, rows, most=32):
    ids, n, deviation, whitened, explained = brute(rows, most)
    k = whitened.shape[1]
    assert Counter(r["vec_id"] for r in found) == {i: k * c for i, c in Counter(ids).items()}
    at = {i: j for j, i in enumerate(ids)}
    signs = {}
    for r in found:
        j, c = at[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[j] and r["identity_error"] <= 1e-4
        assert r["explained"] == pytest.approx(explained[c], rel=1e-8)
        assert abs(r["whitened"]) == pytest.approx(abs(whitened[j, c]), rel=1e-6, abs=1e-6)
        if abs(whitened[j, c]) > 1e-3:
            signs.setdefault(c, set()).add(np.sign(r["whitened"]) == np.sign(whitened[j, c]))
    assert all(len(s) == 1 for s in signs.values())


def test_query_on_the_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = op12_whitening(spark, sf)
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["component"] == "int"
    check(found.collect(), rows)


def test_unusable_and_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.standard_normal(5).astype(np.float32) * [1, 2, 3, 4, 5]]) for i in range(200)]
    usable = rows + [(None, [0.0] * 5), (7, rows[7][1])]
    bad = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0]), (903, [float("nan")] * 5), (904, [float("inf")] + [0.0] * 4), (905, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 0) for r in usable + bad], SCHEMA)
    df = df.select("*", *[F.lit("x").alias(c) for c in "id vector n at d task cells component whitened".split()])
    df.repartition(7).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = op12_whitening(spark, str(tmp_path)).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4, 5}
    # the repeated id has two equal rows
    check(found, usable)
    wide = whitening.whiten(df, whitening.fit(df, components=2)).collect()
    check(wide, usable, most=2)


def test_empty_lone_and_constant(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty, whitening.fit(empty)).collect() == []
    none = spark.createDataFrame([(1, None, 0), (2, [], 0)], SCHEMA)
    assert whitening.whiten(none, whitening.fit(none)).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(3)], SCHEMA)
    found = whitening.whiten(same, whitening.fit(same)).collect()
    assert len(found) == 6 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in found)
    # a dimension that never changes, and one that copies another
    flat = spark.createDataFrame([(i, [float(i), 3.0, float(i)], 0) for i in range(50)], SCHEMA)
    found = whitening.whiten(flat, whitening.fit(flat)).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in found)
    assert all(r["identity_error"] < 1e-9 for r in found)


def test_huge_entries(spark):
    rows = [(1, [3e38, 0.0], 0), (2, [-3e38, 1.0], 0), (3, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r["vec_id"]: r for r in whitening.whiten(df, whitening.fit(df)).where("component = 1").collect()}
    x = [[(1 << 61) + 10**6, 10**6], [-(1 << 61) + 10**6, 64 + 10**6], [64 + 10**6, 128 + 10**6]]
    s = [sum(c) for c in zip(*x, strict=True)]
    want = [sum((3 * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    assert [found[i]["deviation"] for i in (1, 2, 3)] == [w if w < 10**38 else None for w in want]


def _is_decomposition(a, k):
    values, vectors = whitening.leading_components(a, k)
    size = max(np.abs(a).max(), 1e-300) * len(a)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() <= 1e-13 * size
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * size
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() <= 1e-10


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 24), st.integers(0, 10_000), st.sampled_from(["wide", "steps", "equal", "rank", "tiny", "close"]))
def test_components_of_any_matrix(d, seed, kind):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    e = {
        "wide": 10.0 ** rng.uniform(-6, 6, d), "steps": rng.integers(0, 3, d).astype(float), "equal": np.full(d, 2.5),
        "rank": np.where(np.arange(d) < 2, 5.0, 0.0), "tiny": rng.random(d) * 1e-200, "close": 1 + rng.random(d) * 1e-9,
    }[kind]
    a = (q * e) @ q.T
    _is_decomposition((a + a.T) / 2, min(d, 12))


def test_components_of_plain_matrices():
    _is_decomposition(np.zeros((4, 4)), 4)
    _is_decomposition(np.diag([3.0, 1.0, 3.0, 2.0, 3.0]), 5)
    _is_decomposition(np.ones((6, 6)), 6)
    rng = np.random.default_rng(5)
    a = rng.standard_normal((400, 200))
    _is_decomposition(a.T @ a / 400, 32)


def test_sturm_counts():
    rng = np.random.default_rng(1)
    d, e = rng.standard_normal(30), rng.standard_normal(29)
    true = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    points = rng.uniform(-4, 4, 50)
    assert (whitening.counts_below(d, e, points) == (true[None] < points[:, None]).sum(axis=1)).all()
