import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from nightframe.functions import bits, paths, sections, series, times


def column(spark, values, kind, f):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", f(F.col("v")).alias("r"))
    return [r["r"] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("value, expected", [(0, 0), (1, 0), (2, 1), (11, 4), (259, 9)])
def test_set_bit_index_sum(spark, value, expected):
    assert column(spark, [value], "int", bits.set_bit_index_sum) == [expected]


def test_set_bit_index_sum_every_value(spark):
    df = spark.range(65536).select(F.col("id").cast("int").alias("v"))
    got = {r.v: r.s for r in df.select("v", bits.set_bit_index_sum(F.col("v")).alias("s")).collect()}
    assert all(got[v] == sum(i for i in range(16) if v >> i & 1) for v in range(65536))


def test_empty_input(spark):
    assert column(spark, [], "int", bits.set_bit_index_sum) == []


@pytest.mark.parametrize("value, expected", [(0, 0), (1, 1), (2, 1), (11, 3), (259, 3)])
@pytest.mark.parametrize("kind", ["smallint", "int", "bigint"])
def test_set_bits(spark, value, expected, kind):
    assert column(spark, [value], kind, bits.set_bits) == [expected]


@pytest.mark.parametrize("guard, value", [(bits.unsigned, -1), (bits.unsigned16, -1), (bits.unsigned16, 65536)])
def test_guards(spark, guard, value):
    with pytest.raises(PySparkException):
        column(spark, [value], "int", guard)


def test_amplitude_needs_nine_parameters():
    with pytest.raises(ValueError):
        bits.correction_amplitude(None, None, None, [1.0])


def test_sections(spark):
    got = column(spark, ["[1:20,1:64]", "[20:3,64:1]", None], "string", sections.parse_section)
    assert tuple(got[0]) == (0, 20, 1, 0, 64, 1)
    assert tuple(got[1]) == (2, 20, -1, 0, 64, -1)
    assert got[2] is None
    with pytest.raises(PySparkException):
        column(spark, ["[1:20]"], "string", sections.parse_section)


def test_partition_values(spark):
    got = column(
        spark, ["a/run_id=1/channel=B/x.fits", "a=1/a=2/b.fits", "k=v=w/plain", "none/x"], "string", paths.partition_values
    )
    assert got == [{"run_id": "1", "channel": "B"}, {"a": "2"}, {"k": "v=w"}, {}]


def test_suffix_and_name(spark):
    assert column(spark, ["a/b.tar.gz", "a/.hidden", "a/b"], "string", paths.suffix) == [".gz", "", ""]
    assert column(spark, ["a/b.fits"], "string", paths.file_name) == ["b.fits"]


def test_relative_path(spark):
    f = lambda c: paths.relative_to(c, "file:///data/root/")
    assert column(spark, ["file:/data/root/a/b", "file:///data/root/c", "/data/root/d"], "string", f) == ["a/b", "c", "d"]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 11, 40])
def test_running_median_reflects(spark, n):
    rng = np.random.default_rng(n)
    v = rng.normal(size=n)
    index = [i % (2 * n) for i in range(-5, n + 5)]
    padded = np.array([v[i] if i < n else v[2 * n - 1 - i] for i in index])
    want = [float(np.median(padded[i : i + 11])) for i in range(n)]
    got = column(spark, [v.tolist()], "array<double>", lambda c: series.running_median(c, 5))[0]
    assert got == want


@pytest.mark.parametrize("seed", range(4))
def test_running_median_of_odd_cells(spark, seed):
    """Ties, NaN and nulls: in a window numbers come first, then NaN, then nulls."""
    rng = np.random.default_rng(seed)
    pool = [1.0, 1.0, -2.0, 0.0, 7.5, float("nan"), float("inf"), None]
    lines = [[pool[i] for i in rng.integers(0, top, size=n)] for n in (1, 4, 12, 60) for top in (2, 7, 8)]
    got = column(spark, [*lines, [], [None] * 7], "array<double>", lambda c: series.running_median(c, 5))
    rank = lambda v: (v is None, v is not None and np.isnan(v), 0.0 if v is None or np.isnan(v) else v)
    for v, medians in zip(lines, got, strict=False):
        n = len(v)
        cells = [i % (2 * n) for i in range(-5, n + 5)]
        padded = [v[i] if i < n else v[2 * n - 1 - i] for i in cells]
        want = [sorted(padded[i : i + 11], key=rank)[5] for i in range(n)]
        assert [repr(x) for x in medians] == [repr(x) for x in want]
    assert got[-2:] == [[], [None] * 7]


def test_pooled_variance(spark):
    rng = np.random.default_rng(7)
    groups = [rng.normal(1e4, 3, size=k) for k in (3, 8, 1)]
    parts = [(float(len(g)), float(g.mean()), float(g.var())) for g in groups] + [(0.0, 0.0, 0.0)]
    got = column(spark, [parts], "array<struct<n:double,mean:double,var:double>>", series.pooled_variance)[0]
    assert got == pytest.approx(np.concatenate(groups).var(), rel=1e-9)


def test_shifted(spark):
    f = lambda k: column(spark, [[1, 2, 3, 4]], "array<int>", lambda c: series.shifted(c, k))[0]
    assert f(2) == [None, None, 1, 2]
    assert f(-1)[:3] == [2, 3, 4]
    assert f(6) == [None] * 4


def test_log_time(spark):
    got = column(
        spark,
        ["Tue Jan  2 03:04:05 UTC 2024", "Tue Jan 12 03:04:05 HST 2024 ", "rubbish"],
        "string",
        lambda c: F.struct(times.utc_wall_clock(times.log_time(c)["time"]).alias("t"), times.log_time(c)["zone"].alias("z")),
    )
    assert str(got[0].t) == "2024-01-02 03:04:05" and got[0].z == "UTC"
    assert str(got[1].t) == "2024-01-12 03:04:05" and got[1].z == "HST"
    assert got[2].t is None


def test_times_ignore_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        r = spark.range(1).select(
            times.utc_wall_clock(times.local_minute(F.lit("2024 1 31 23 30"))).alias("a"),
            times.utc_wall_clock(times.header_time(F.lit("str"), F.lit(None), F.lit("2024-01-02T03:04:05"))).alias("b"),
            times.utc_wall_clock(times.header_time(F.lit("int"), F.lit(0.0), F.lit(None))).alias("c"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (str(r.a), str(r.b), str(r.c)) == ("2024-02-01 09:30:00", "2024-01-02 03:04:05", "1970-01-01 00:00:00")


def test_impossible_minutes_are_null(spark):
    f = lambda c: times.local_minute(c)
    got = column(spark, ["2024 13 1 0 0", "2024 02 09 07 05", "2024 1", "x 1 1 1 1"], "string", f)
    assert got[0] is None and str(got[1]) == "2024-02-09 17:05:00" and got[2:] == [None, None]
