"""Budgets down the tree against a recursive division, prefixes against sorting."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from nightframe.llm import mixing as M


def brute_share(total, children):
    """``children``: name -> (supply, weight). Gives to all by weight until none is exhausted."""
    out, left = {}, {k: v for k, v in children.items() if v[1] > 0}
    while left:
        weights = sum(w for _, w in left.values())
        done = [k for k, (s, w) in left.items() if s * weights <= w * total]
        if not done:
            return {k: 0 for k in children} | out | {k: w * total // weights for k, (_, w) in left.items()}
        first = min(done, key=lambda k: (left[k][0] / left[k][1], k))
        out[first] = left[first][0]
        total -= left.pop(first)[0]
    return {k: 0 for k in children} | out


def brute_budgets(leaves, weights, percent, epochs):
    weigh = lambda level, name: weights.get((level, name), 1)
    supply = lambda p: sum(n for k, n in leaves.items() if k[: len(p)] == p) * epochs
    out = {}

    def down(path, total):
        if len(path) == 3:
            out[path] = total
            return
        level = M.LEVELS[len(path)]
        names = {k[len(path)] for k in leaves if k[: len(path)] == path}
        shares = brute_share(total, {n: (supply((*path, n)), weigh(level, n)) for n in names})
        for n, share in shares.items():
            down((*path, n), share)

    down((), sum(leaves.values()) * percent // 100)
    return out


def random_docs(seed, n=600):
    rng = random.Random(seed)
    sources = [f"src{i}" for i in range(6)]
    return [
        (i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["en", "en", "de", None]),
         rng.choice(sources + ["src0"] * 5 + [None]), 0)
        for i in range(n)
    ]


def expected(rows, weights, percent, epochs, seed, domain):
    leaves, docs = defaultdict(int), defaultdict(list)
    for r in rows:
        key = (domain(r[3]), r[2] or "", r[3] or "")
        n = len(r[1].split()) if r[1] else 0
        leaves[key] += n
        docs[key].append((str(r[0]) if r[0] is not None else "", n))
    out = []
    for key, budget in brute_budgets(leaves, weights, percent, epochs).items():
        whole = budget // leaves[key] if leaves[key] else 0
        rest = budget - whole * leaves[key]
        out += [(i, e) for i, _ in docs[key] for e in range(whole)]
        place = lambda i: hashlib.md5(f"{seed}:{whole}:{i}".encode()).hexdigest()  # noqa: E731, B023
        total, same = 0, defaultdict(list)
        for i, n in docs[key]:
            same[place(i)].append((i, n))
        for p in sorted(same):
            total += sum(n for _, n in same[p])
            if total > rest or not rest:
                break
            out += [(i, whole) for i, _ in same[p]]
    return sorted(out)


def test_mix_is_brute_forces(spark, docs_of):
    schema = docs_of().schema
    weights = {("domain", "big"): 1, ("domain", "small"): 4, ("lang", "de"): 3, ("source", "src2"): 0}
    table = spark.createDataFrame([(*k, w) for k, w in weights.items()], "level string, name string, weight int")
    domain = F.when(F.col("source") == "src0", "big").otherwise("small")
    for seed, percent, epochs in ((1, 50, 2), (2, 90, 1), (3, 150, 3), (4, 5, 1)):
        rows = random_docs(seed)
        rows += [rows[0], (None, "a b", "en", "src1", 3), (None, None, None, None, None)]
        got = M.mix(spark.createDataFrame(rows, schema), table, domain, percent, epochs, seed)
        found = sorted((str(r["doc_id"]) if r["doc_id"] is not None else "", r["mix_epoch"]) for r in got.collect())
        assert found == expected(rows, weights, percent, epochs, seed, lambda s: "big" if s == "src0" else "small")


def test_shortages_go_to_siblings_first(spark):
    supply = spark.createDataFrame(
        [("a", "x", "1", 10), ("a", "x", "2", 1000), ("a", "y", "3", 1000), ("b", "x", "4", 1000)],
        "domain string, lang string, source string, tokens long",
    )
    none = spark.createDataFrame([], "level string, name string, weight int")
    got = {r["source"]: r["budget"] for r in M.budgets(supply, none, 20, 1).collect()}
    assert got == {"1": 10, "2": 140, "3": 150, "4": 301}


def test_empty_table_and_extra_columns(spark, docs_of):
    none = spark.createDataFrame([], "level string, name string, weight int")
    assert M.mix(docs_of(), none, F.lit("d")).count() == 0
    docs = docs_of("a b c", "d e f", extra=True)
    assert M.mix(docs, none, F.lit(None).cast("string"), 100, 1).count() == 2


def test_columns_of_any_name(spark, docs_of):
    none = spark.createDataFrame([], "level string, name string, weight int")
    names = "rest whole cut budget place range tokens through before domain supply above weight mix_tokens MIX_budget id order".split()
    docs = docs_of("a b c", "d e f").select("*", *[F.lit(n).alias(n) for n in names])
    got = M.mix(docs, none, F.lit("d"), 100, 1)
    kept = [c for c in docs.columns if c not in ("mix_tokens", "MIX_budget")]
    assert got.columns == [*kept, "mix_epoch", "mix_tokens", "mix_budget"]
    rows = got.collect()
    assert len(rows) == 2 and all(r[n] == n for r in rows for n in names if n in kept) and {r["mix_tokens"] for r in rows} == {3}
    assert M.mix(docs, none, F.lit("d"), 100, 1, prefix="x_").columns == [*docs.columns, "x_epoch", "x_tokens", "x_budget"]
    assert M.mix(docs_of("w " * 2_000_000), none, F.lit("d"), 100, 1).first()["mix_tokens"] == 2_000_000
