"""URL filters: parts, rules and the digest index against plain Python."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from nightframe.llm import urls as U
from nightframe.llm.registry import URL_RULES

PAGES = "page_id long, url string, html string, host string, path string, rule string, entry string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host) :])[0]


def decide(host, path, listed):
    fit = [
        (len(t), t, k) for k, t in URL_RULES
        if (host == t.partition("/")[0] or host.endswith("." + t.partition("/")[0])) and path.startswith("/" + t.partition("/")[2])
    ]
    if fit:
        return max(fit)[1:]
    names = host.split(".")
    domains = [".".join(names[i:]) for i in range(len(names))] if host else []
    folders = ["", path, *(path[: i + 1] for i, c in enumerate(path) if c == "/")]
    return None, "block" if any(d + f in listed for d in domains for f in folders) else "allow"


def make(spark, values):
    return spark.createDataFrame([(i, u, "", "a", "b", "c", "d") for i, u in enumerate(values)], PAGES)


def test_judgement_is_plain_pythons(spark):
    rng = random.Random(3)
    hosts = ["example.org", "A.Example.ORG", "xexample.org", "x.com", "b.x.com", "É.com", "net", "bad.net", "a.bad.net", "", "org", "com"]
    paths = ["", "/", "/es/1", "/es", "/en/1", "/en/12/3", "/fr/", "/de/x", "/mixed/Case/f.html", "/mixed/Case/g"]
    ends = ["", "?q=/es/", "#top", "?a#b", "\n/x"]
    values = [f"{rng.choice(['http', 'a://b'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(ends)}" for _ in range(500)]
    values += [None, "", "no scheme/x", "://", "://org", "://org/", "http:/x"]
    listed = ["bad.net", "x.com/mixed/", "net/en/1", "other.example", None, "bad.net"]
    index = U.build_index(spark.createDataFrame([(e,) for e in listed], "entry string"))
    rows = U.judge(make(spark, values), index, URL_RULES).collect()
    assert len(rows) == len(values)
    for r in rows:
        host, path = parts(values[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        rule, verdict = decide(host, path, {e for e in listed if e})
        assert (r["rule"], r["verdict"]) == (rule, verdict), values[r["page_id"]]


def write(path, entries):
    path.write_bytes(b"".join(U._index_bytes(entries)))
    return U.Index(str(path))


def test_index_confirms_texts(tmp_path):
    rng = random.Random(1)
    keys = sorted({bytes(rng.choices(range(97, 123), k=rng.randint(1, 8))) for _ in range(5000)})
    index = write(tmp_path / "i", sorted((xxhash.xxh64_intdigest(k), k) for k in keys[::2]))
    assert (index.contains(keys) == (np.arange(len(keys)) % 2 == 0)).all()
    assert not index.contains([]).size
    # entries stored under another key's digest: the digest is found, the text isn't
    forged = write(tmp_path / "f", [(xxhash.xxh64_intdigest(b"real"), b"false"), (xxhash.xxh64_intdigest(b"real"), b"other")])
    assert not forged.contains([b"real", b"false"]).any()
    both = write(tmp_path / "b", [(xxhash.xxh64_intdigest(b"real"), b"false"), (xxhash.xxh64_intdigest(b"real"), b"real")])
    assert both.contains([b"real"]).all()


def test_empty_lists_tables_and_bounds(spark):
    none = spark.createDataFrame([], "entry string")
    index = U.build_index(none)
    assert [r["verdict"] for r in U.judge(make(spark, ["http://a.b/c"]), index, []).collect()] == ["allow"]
    assert U.judge(make(spark, ["x"]).where("false"), index, URL_RULES).count() == 0
    with pytest.raises(ValueError, match="split"):
        U.build_index(spark.createDataFrame([("a" * 100,)], "entry string"), max_bytes=50)


def test_no_shuffle(spark):
    index = U.build_index(spark.createDataFrame([("a.b",)], "entry string"))
    plan = U.judge(make(spark, ["http://a.b"]), index, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert U.judge(make(spark, ["http://c.a.b"]), index, URL_RULES).select(F.col("verdict")).first()[0] == "block"


def test_a_domain_as_long_as_the_longest_entry_is_a_key():
    host, path = b"d.c.a.b", b"/x/y"
    domains = [b"b", b"a.b", b"c.a.b", b"d.c.a.b"]
    every = {d + f for d in domains for f in (b"", b"/", b"/x/", b"/x/y")}
    for longest in range(13):
        assert set(U._keys(host, path, longest)) == {key for key in every if len(key) <= longest}, longest
