"""Quality rules and the classifier: brute-force counts, held-out accuracy, odd rows."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from nightframe.llm import quality_classifier as C
from nightframe.llm import quality_rules as Q

SPACES = " \t\n\r\x0b\x0c"


def brute_words(text):
    out = [""]
    for c in text:
        if c in SPACES:
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w]


def brute_base(text):
    words = brute_words(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = text.split("\n")
    duplicates = sum(1 for i, x in enumerate(lines) if brute_words(x) and x in lines[:i])
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(covered)


def test_base_counts_are_brute_forces():
    rng = random.Random(2)
    pieces = ["a", "b", "c", "dé", "#x", "日本", "|", "&<", "\x1c", " ", "\u0085"]
    for _ in range(200):
        text = "".join(rng.choice(pieces) + rng.choice([" ", "\n", "\t", "  ", "\r\n"]) for _ in range(rng.randint(0, 60)))
        assert Q.base_counts(text.encode()) == brute_base(text)


def test_ratio_is_brute_forces(spark, docs_of):
    good = ["the clean text of a page " * 12, "another clean page of the text " * 3 + "with other words " * 15]
    bad = ["### buy *** now $$$ " * 20, None, ""]
    docs, buckets = docs_of(*good, *bad, extra=True), 512
    trusted = spark.createDataFrame([(0,), (1,)], "trusted_id long")
    rows = {r["doc_id"]: r for r in Q.judge(docs, trusted, buckets=buckets).collect()}
    raw, target = np.zeros(buckets), np.zeros(buckets)
    grams = [Q.hashed_ngrams((t or "").encode(), buckets) for t in good + bad]
    for i, g in enumerate(grams):
        raw += np.bincount(g, minlength=buckets)
        target += np.bincount(g, minlength=buckets) * (i < 2)
    ratio = np.log(((target + 1) / (target.sum() + buckets)) / ((raw + 1) / (raw.sum() + buckets)))
    for i, g in enumerate(grams):
        llr = ratio[g].mean() if len(g) else 0.0
        assert abs(rows[i]["llr"] - llr) < 1e-5
        assert rows[i]["kept"] == (not rows[i]["base_failed"] and llr >= -0.25)
    assert rows[3]["base_failed"] and rows[4]["base_failed"] and rows[3]["n_words"] == 0


def test_rules_without_labels_or_rows(spark, docs_of):
    none = Q.trusted_ids(spark.createDataFrame([], "doc_id long, quality int"), 10)
    rows = Q.judge(docs_of((None, "word " * 60), (1, " ".join(f"w{i}" for i in range(60)))), none).collect()
    assert sorted((r["llr"], r["kept"]) for r in rows) == [(0.0, False), (0.0, True)]
    assert Q.judge(docs_of(), none).count() == 0


def labelled_corpus(rng, n):
    words = [f"{a}{b}" for a in ("ba", "ko", "ri", "tu") for b in ("len", "mas", "ton", "ser", "vid")]
    texts, y = [], []
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(100, 400)))
        if i % 4 == 0:  # one bad passage somewhere
            parts = text.split()
            at = rng.randrange(len(parts) - 70)
            parts[at : at + 64] = [w + rng.choice(["###", "$$$", "%%"]) for w in parts[at : at + 64]]
            text = " ".join(parts)
        texts.append(text)
        y.append(int(i % 4 != 0))
    return texts, y


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    w = {"encode": (6, 5), "encode_bias": (5,), "tanh": (5, 4), "gate": (5, 4), "attend": (4,), "score": (5,), "score_bias": ()}
    w = {k: np.asarray(rng.normal(0, 0.7, s)) for k, s in w.items()}
    x, sizes, y = rng.normal(0, 1, (9, 6)), np.array([2, 4, 3]), np.array([1.0, 0.0, 1.0])
    starts = np.array([0, 2, 6])

    def loss():
        p = C._forward(w, x, starts, sizes)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, grad in C._gradients(w, x, starts, sizes, y).items():
        flat, g = w[name].reshape(-1), np.asarray(grad).reshape(-1)
        for i in range(flat.size):
            kept = flat[i]
            flat[i] = kept + 1e-6
            up = loss()
            flat[i] = kept - 1e-6
            down = loss()
            flat[i] = kept
            assert abs((up - down) / 2e-6 - g[i]) < 1e-5


def test_classifier_on_held_out_texts(spark, docs_of):
    texts, y = labelled_corpus(random.Random(3), 400)
    labels = spark.createDataFrame([(i, v) for i, v in enumerate(y)], "doc_id long, quality int")
    docs = docs_of(*texts, extra=True)
    model = C.learn(docs, labels, F.col("doc_id") < 300, epochs=30)
    rows = C.judge(docs, model).where("doc_id >= 300").collect()
    right = sum((r["score"] >= 0.5) == bool(y[r["doc_id"]]) for r in rows)
    assert right >= 0.95 * len(rows)
    assert all(abs(sum(r["attention"]) - 1) < 1e-3 for r in rows)


def test_classifier_on_odd_rows(spark, docs_of):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    docs = docs_of("fine words here", "### ###", None, "", (None, "x"), (None, "x"))
    model = C.learn(docs, labels, epochs=2)
    rows = C.judge(docs, model).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert C.judge(docs_of(), model).count() == 0
    empty = C.learn(docs_of(), labels)
    assert {r["score"] for r in C.judge(docs, empty).collect()} == {0.5}
