import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nightframe.operators import percentiles as Q
from nightframe.operators.percentiles import approximate_percentiles, exact_percentiles


def groups():
    rng = np.random.default_rng(1)
    return {
        "normal": rng.normal(300, 5, 4000),
        "one_value": np.full(50, 7.25),
        "hot": np.concatenate([np.zeros(3000), rng.normal(size=100)]),
        "third": np.concatenate([np.full(2000, 311.5), rng.normal(300, 20, 4000)]),
        "wide": 10.0 ** rng.uniform(-300, 300, 2000) * rng.choice([-1, 1], 2000),
        "close": 1e6 + rng.integers(0, 5, 1000) * 1e-9,
        "least": rng.integers(-9, 9, 500) * 5e-324,
        "infinite": np.array([-np.inf, -np.inf, 1.0, 2.0, np.inf, np.inf, np.inf, np.inf]),
        "single": np.array([-3.5]),
        "two": np.array([1.0, 2.0]),
        "": np.array([4.0, -0.0, 0.0]),
    }


P = [0.0, 0.01, 0.5, 0.99, 1.0]


def frame(spark, data):
    rows = [(g or None, float(v)) for g, vs in data.items() for v in vs] + [("normal", None), ("two", float("nan")), ("none", None)]
    return spark.createDataFrame(rows, "g string, v double")


def check(found, data):
    got = {r.g or "": r.percentiles for r in found.collect()}
    assert set(got) == set(data)
    for g, vs in data.items():
        want = np.percentile(vs, [q * 100 for q in P])
        if g == "infinite":  # numpy gives nan
            want = [-np.inf, -np.inf, np.inf, np.inf, np.inf]
        np.testing.assert_allclose(got[g], want, rtol=1e-12)


# all bits at once, pass by pass, and groups in lots
@pytest.mark.parametrize(("few", "sent"), [(Q.FEW, Q.SENT_GROUPS), (0, Q.SENT_GROUPS), (0, 3)])
def test_exact_percentiles_match_numpy(spark, few, sent):
    data = groups()
    check(exact_percentiles(frame(spark, data), ["g"], "v", P, few=few, sent_groups=sent), data)


def test_no_group_at_all(spark):
    assert exact_percentiles(frame(spark, {}), ["g"], "v", P).collect() == []


def bits(values):
    raw = np.array(values, np.float64).view(np.int64)
    return [int(r) if r >= 0 else -int(r & 0x7FFFFFFFFFFFFFFF) for r in raw]


EDGES = [0.0, -0.0, 1.0, -1.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, np.inf, -np.inf]
EDGES += [float(np.nextafter(2.0**e, d)) for e in (-1022, -1000, -1, 0, 1, 3, 29, 52, 53, 1000, 1023) for d in (0.0, np.inf)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=400))
def test_code_is_the_value_s_bits(spark, values):
    values = values + EDGES
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    found = rows.select("i", Q.code(F.col("v")).alias("c"), Q.decoded(Q.code(F.col("v"))).alias("back")).orderBy("i").collect()
    assert [r.c for r in found] == bits(values)
    assert [r.back for r in found] == values


def test_only_counts_are_exchanged(spark, monkeypatch):
    """What a pass exchanges is bounded by cells, not by values."""
    sizes = []
    held = Q._held

    def watched(cells, wanted, group):
        sizes.append(cells.count())
        return held(cells, wanted, group)

    monkeypatch.setattr(Q, "_held", watched)
    n = 300_000
    v = F.when(F.col("id") % 3 == 0, F.lit(101.5)).otherwise(100 + F.rand(1))
    rows = spark.range(n).select(F.lit("a").alias("g"), v.alias("v"))
    got = exact_percentiles(rows, ["g"], "v", [0.01, 0.5, 0.99], few=1 << 12).first().percentiles
    want = rows.agg(F.expr("percentile(v, array(0.01, 0.5, 0.99))")).first()[0]
    assert got == pytest.approx(want, rel=1e-12)
    # 1/1024 of an octave, then the distinct values of three cells
    assert sizes[0] < 100 and sum(sizes[1:]) < n / 10
    plan = str(rows._jdf.queryExecution().executedPlan())
    assert "Exchange" not in plan


def test_approximate_percentiles_are_near(spark):
    df = spark.range(100001).selectExpr("id % 1 AS g", "CAST(id AS DOUBLE) AS v")
    got = approximate_percentiles(df, ["g"], "v", [0.01, 0.99]).first().percentiles
    assert got == pytest.approx([1000, 99000], abs=20)
