import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from nightframe import schemas
from nightframe.operators import catalog as C
from nightframe.operators import headers as H
from nightframe.operators import match as M
from nightframe.operators import quality as DQ

FILES = [
    ("p1", "OBJECT", "r1", "s", "B"), ("p2", "OBJECT", "r1", None, "B"), ("p3", "OBJECT", "r2", "s", "R"),
    ("a2", "ARC", "r1", "s", "B"), ("a1", "ARC", "r1", "s", "B"), ("a3", "ARC", "r1", None, "B"), ("a4", "ARC", "r1", "s", "R"),
    ("f1", "FLAT", "r1", "s", "B"), ("f2", "FLAT", "r1", "s", "B"), ("m", "BINARY_OFFSET_MODEL", None, None, "B"),
    ("w2", "WEATHER", None, None, None), ("w1", "WEATHER", None, None, None), ("l", "RAW_LOGS", None, None, None),
]


@pytest.fixture(scope="module")
def store(spark):
    return spark.createDataFrame(FILES, "file_path string, type string, run_id string, object string, channel string").cache()


@pytest.fixture(scope="module")
def primaries(store):
    return store.filter("type = 'OBJECT'")


def pairs(df):
    return sorted((r.file_path, r.match_path) for r in df.collect())


def brute(file_type, keys):
    return sorted(
        (p[0], c[0])
        for p in FILES if p[1] == "OBJECT"
        for c in FILES
        if c[1] == file_type and all(p[k] is not None and p[k] == c[k] for k in keys)
    )


@pytest.mark.parametrize("file_type, keys", [("ARC", (2, 3, 4)), ("FLAT", (2, 3, 4)), ("BINARY_OFFSET_MODEL", (4,))])
def test_all_matches(store, primaries, file_type, keys):
    assert pairs(M.all_matches(file_type, primaries, store)) == brute(file_type, keys)


def test_first_match_is_first_in_path_order(store, primaries):
    got = {r.file_path: (r.match_path, r.n_matches) for r in M.first_match("ARC", primaries, store).collect()}
    assert got == {"p1": ("a1", 2), "p2": (None, 0), "p3": (None, 0)}


def test_no_match_fails_when_strict(store, primaries):
    with pytest.raises(PySparkException, match="no matches found for ARC"):
        M.first_match("ARC", primaries, store, strict=True).collect()


def test_global_rule(store, primaries):
    got = {(r.match_path, r.n_matches) for r in M.first_match("WEATHER", primaries, store).collect()}
    assert got == {("w1", 2)}
    assert {r.match_path for r in M.members("RAW_LOGS", store).collect()} == {"l"}
    with pytest.raises(ValueError):
        M.all_matches("WEATHER", primaries, store)


def test_global_rule_without_candidates(store, primaries):
    got = M.first_match("WEATHER", primaries, store.filter("type <> 'WEATHER'")).collect()
    assert {(r.match_path, r.n_matches) for r in got} == {(None, 0)}


def test_registry_errors():
    with pytest.raises(ValueError):
        M.registry.register(M.MatchRule("ARC", ("run_id",)))
    with pytest.raises(KeyError):
        M.registry.rule("RASTER")


def test_given_flats_win(store, primaries):
    given = primaries.withColumn("continuum_files", F.when(F.col("file_path") == "p3", F.array(F.lit("x"))))
    assert pairs(M.continuum_files(given, store)) == [("p1", "f1"), ("p1", "f2"), ("p3", "x")]
    got = {r.file_path: (r.n_flats, r.first_flat) for r in M.resolve_science(given, store).collect()}
    assert got == {"p1": (2, "f1"), "p2": (0, None), "p3": (1, "x")}


def test_hot_key_stays_linear(spark):
    """A third of all files in one match set: results and plan stay one row per primary."""
    rows = spark.range(30000).select(
        F.concat(F.lit("f"), F.col("id")).alias("file_path"),
        F.when(F.col("id") % 2 == 0, "OBJECT").otherwise("ARC").alias("type"),
        F.lit("r").alias("run_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("object"),
        F.lit("B").alias("channel"),
    )
    found = M.first_match("ARC", rows.filter("type = 'OBJECT'"), rows)
    assert found.count() == 15000
    assert found.agg(F.max("n_matches")).first()[0] == 5000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_cross_join_for_global_rules(store, primaries):
    plan = M.resolve_science(primaries, store)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_models_of_exposures(spark, store):
    exposures = spark.createDataFrame([(1, "B"), (2, "R")], "exposure_id int, channel string")
    models = spark.createDataFrame([("m", [[1.0]]), ("other", [[2.0]])], "file_path string, parameters array<array<double>>")
    got = M.models_of_exposures(exposures, store, models).collect()
    assert [(r.channel, r.parameters) for r in got] == [("B", [[1.0]])]


def test_lookup_errors(spark, store):
    wanted = lambda *names: spark.createDataFrame([(n,) for n in names], "file_path string")
    assert C.lookup(wanted("p1"), store).count() == 1
    with pytest.raises(PySparkException, match="not in catalogue"):
        C.lookup(wanted("nope"), store).collect()
    with pytest.raises(PySparkException, match="several records"):
        C.lookup(wanted("p1"), store.unionByName(store)).collect()


def test_ragged_union_types(spark):
    a = spark.createDataFrame([("k", 1, 2)], "file_path string, n int, m int")
    b = spark.createDataFrame([("l", "text", 2.5)], "file_path string, n string, m double")
    got = C.ragged_union(a, b)
    assert dict(got.dtypes) == {"file_path": "string", "n": "string", "m": "double"}
    assert got.count() == 2


def test_fingerprint_ignores_order_and_ingest_time(store):
    again = store.orderBy(F.desc("file_path")).withColumn("time_added", F.current_timestamp())
    one = C.fingerprint(store.withColumn("time_added", F.lit(None))).first()
    assert one == C.fingerprint(again).first()
    assert one != C.fingerprint(store.filter("file_path <> 'p1'")).first()
    doubled = C.fingerprint(store.unionByName(store.filter("file_path = 'p1'"))).first()
    assert doubled != one


def test_typed_getters(spark):
    rows = [(1, 0, "A", "float", None, 2.9, None), (1, 0, "B", "bool", None, None, True), (1, 0, "S", "str", "x", None, None)]
    h = spark.createDataFrame(
        rows, "exposure_id int, image_no int, key string, vtype string, value_str string, value_double double, value_bool boolean"
    )
    images = h.select("exposure_id", "image_no").distinct()
    get = lambda *a, **k: H.get(images, h, *a, **k).first().value
    assert get("A", "int") == 2 and get("A", "float") == 2.9
    assert get("B", "int") == 1 and get("B", "bool") is True and get("S", "str") == "x"
    assert get("Z", "int", default=7) == 7 and get("Z", "str", default="d") == "d"
    with pytest.raises(PySparkException, match="is not an int"):
        get("S", "int")
    with pytest.raises(PySparkException, match="is not a bool"):
        get("A", "bool")
    with pytest.raises(PySparkException, match="not available"):
        get("Z", "float", required=True)


def test_quality_rules(spark, store):
    assert DQ.catalog_violations(store.withColumn("file_name", F.lit("n")).withColumn("time_added", F.lit(1))).count() == 0
    bad = DQ.in_domain(store, "file_path", "type", ("OBJECT",))
    assert bad.count() == 10
    with pytest.raises(ValueError, match="domain"):
        DQ.require_clean(bad)
    amps = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (2, 0), (3, 0), (3, 1), (3, 2)], "exposure_id int, amp int")
    assert sorted((r.key, r.detail) for r in DQ.two_images(amps).collect()) == [("2", "1"), ("3", "3")]
    assert schemas.SCIENCE in schemas.FILE_TYPES
