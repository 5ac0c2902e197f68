"""Very long texts, and columns with the names that operators use for themselves."""

import random
import time

import pytest
from pyspark.sql import functions as F

from nightframe.llm import quality_classifier, quality_rules, search, simhash, toxicity, urls

LONG = ["long word " * 150_000, "x" * 600_000, "a\n" * 200_000, "nasty " * 100_000]
NAMES = "text_ fp score row seg piece label id y rank rest whole cut place range key a b root first n tokens value base spans".split()


@pytest.fixture(scope="module")
def small(spark, docs_of):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)] + ["nasty"]
    texts = [" ".join(rng.choices(words, k=80)) + (" nasty" if i % 3 == 0 else "") for i in range(60)]
    docs = docs_of(*texts, *LONG).select("*", *[F.lit("z").alias(n) for n in NAMES])
    labels = spark.createDataFrame([(i, int(i % 2), int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    return docs, labels, texts


def test_scores(spark, small):
    docs, labels, texts = small
    n = len(texts) + len(LONG)
    assert toxicity.passages(docs, toxicity.learn(docs, labels)).count() == n
    judged = quality_classifier.judge(docs, quality_classifier.learn(docs, labels)).collect()
    assert len(judged) == n and all(0 <= r["score"] <= 1 for r in judged)
    rules = {r["doc_id"]: r for r in quality_rules.judge(docs, quality_rules.trusted_ids(labels, rows=100)).collect()}
    assert len(rules) == n and rules[60]["n_words"] == 300_000 and rules[62]["n_dup_lines"] == 199_999
    assert rules[61]["word_chars"] == 600_000


def test_fingerprints(spark, small):
    docs, _, texts = small
    found = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(docs, [F.col("doc_id")]).collect()}
    assert len(found) == len(texts) + len(LONG) and all(found[60 + i] == list(simhash.fingerprint(t.encode()).view("int64")) for i, t in enumerate(LONG))


def test_search(spark, small):
    docs, _, texts = small
    found = search.top_k_of_many(search.build_index(docs), docs.where("doc_id >= 60"), k=1).collect()
    assert {r["query_id"] for r in found} == {60, 61, 62, 63} and all(r["score"] > 0 for r in found)


def test_urls(spark):
    listed = ["bad.org", "c.org/a/", "b.c.org/x/y"]
    index = urls.build_index(spark.createDataFrame([(e,) for e in listed], "entry string"))
    cases = {
        "http://bad.org/" + "a/" * 300_000: "block", "http://" + "a." * 300_000 + "bad.org/": "block", "http://" + "a." * 300_000 + "good.org": "allow",
        "http://c.org/a/" + "b" * 900_000: "block", "http://c.org/a": "allow", "http://z.b.c.org/x/y": "block", "http://b.c.org/x/y/": "allow",
        "http://" + "x" * 900_000: "allow",
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string")
    pages = pages.select("*", *[F.lit("z").alias(n) for n in "host path rule verdict __ruled __listed".split()])
    began = time.time()
    found = {r["page_id"]: r["verdict"] for r in urls.judge(pages, index, []).collect()}
    assert [found[i] for i in range(len(cases))] == list(cases.values())
    assert time.time() - began < 30
