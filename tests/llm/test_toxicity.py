"""Toxic passages: all maximal segments against brute force, held-out accuracy, odd rows."""

import random

from pyspark.sql import functions as F

from nightframe.llm import toxicity as X
from nightframe.llm.labelled import remainder


def brute_segments(scores):
    """The definition: the best segment (shortest of equals), then the same left and right of it."""
    best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    a, b = best[3], best[4]
    left = brute_segments(scores[:a])
    right = [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]
    return [*left, (a, b, best[0]), *right]


def test_segments_are_brute_forces():
    rng = random.Random(4)
    for _ in range(200):
        n, background = rng.randint(0, 14), -rng.choice([0.3171, 0.7713, 1.9137])
        hits = [(i, rng.choice([0.5319, 1.3723, 2.9177])) for i in range(n) if rng.random() < 0.4]
        scores = [dict(hits).get(i, background) for i in range(n)]
        got = X.maximal_segments(hits, n, background)
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want, strict=True))


def corpus(rng, n):
    words, bad = [f"w{i}" for i in range(300)], ["vile", "nasty", "awful"]
    texts, toxic = [], []
    for i in range(n):
        parts = rng.choices(words, k=rng.randint(30, 200))
        if i % 5 == 0:
            for at in rng.sample(range(len(parts)), 4):
                parts[at] = rng.choice(bad) + rng.choice(["", ",", "!"])
        texts.append(" ".join(parts))
        toxic.append(int(i % 5 == 0))
    return texts, toxic


def test_held_out_texts(spark, docs_of):
    texts, toxic = corpus(random.Random(6), 600)
    docs = docs_of(*texts, extra=True)
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = X.learn(docs, labels, ~held_out)
    assert set(model.weights) == {b"vile", b"nasty", b"awful"}
    rows = X.passages(docs, model).where(held_out).collect()
    assert all((r["score"] >= 0.7) == bool(toxic[r["doc_id"]]) for r in rows)
    for r in rows:
        words = X.tokens(texts[r["doc_id"]].encode())
        assert all(words[s["start"]] in model.weights and words[s["end"] - 1] in model.weights for s in r["segments"])
    column = {r["doc_id"]: r["s"] for r in docs.select("doc_id", X.scores(F.col("text"), model).alias("s")).collect()}
    assert all(column[r["doc_id"]] == r["score"] for r in rows)


def test_a_group_of_copies_teaches_nothing_of_its_words(spark, docs_of):
    texts, toxic = corpus(random.Random(7), 300)
    rare = " ".join(f"rare{i}" for i in range(40))
    copies = [f"{rare} vile tail{i}" for i in range(40)]
    labels = spark.createDataFrame(list(enumerate(toxic + [1] * 40)), "doc_id long, toxic int")
    model = X.learn(docs_of(*texts, *copies), labels)
    assert not any(t.startswith(b"rare") for t in model.weights)


def test_odd_rows(spark, docs_of):
    docs = docs_of(None, "", "plain", (None, "vile"), (None, "vile"), "!!! \x00 ###")
    labels = spark.createDataFrame([(0, 1), (2, 0), (None, 1), (1, None)], "doc_id long, toxic int")
    for model in (X.learn(docs, labels), X.Model({b"vile": 9.0}, -0.1, 1.0, 0.01, -3.0, 4.0, 0.05)):
        rows = X.passages(docs, model).collect()
        assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert X.passages(docs_of(), model).count() == 0
