"""Near-duplicates against brute force, and rows that are odd."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from nightframe.llm import simhash as S
from nightframe.llm.components import connected_components


def brute_print(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, distance):
    label = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                if (a ^ b).bit_count() <= distance and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def near_texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    out = []
    for _ in range(n):
        text = rng.choices(words, k=120)
        for _ in range(4):
            copy = list(text)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return out


def test_fingerprint_is_sparks_hash(spark):
    texts = ["Some wörds Ä here now and then", "one two", "", "  \t ", None, "A b\x0bc\x1cd e"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [int(r["fp"][0]) % (1 << 64) for r in S.fingerprints(df, [F.lit(1).alias("k")]).collect()]
    assert sorted(got) == sorted(brute_print(t) for t in texts)
    one = spark.sql("SELECT xxhash64('one two') AS h").first()["h"] % (1 << 64)
    assert brute_print("One two") == one


@pytest.mark.parametrize("segments", [2, 3, 4])
def test_groups_are_those_of_brute_force(spark, docs_of, segments):
    texts = near_texts(30, segments) + ["", None, "same words", "same words"]
    found = S.near_duplicates(docs_of(*texts), segments=segments).collect()
    prints = [brute_print(t) for t in texts]
    groups = brute_groups(set(prints), 4)
    smallest = {}
    for i, p in enumerate(prints):
        smallest.setdefault(groups[p], i)
    assert len(found) == len(texts)
    for r in found:
        assert r["fp"][0] % (1 << 64) == prints[r["doc_id"]]
        assert r["component_id"] == smallest[groups[prints[r["doc_id"]]]]


def test_radii_miss_no_pair():
    rng = np.random.default_rng(1)
    for segments in (2, 3, 4):
        cuts, radii = S.segment_bits(64, segments), S.segment_radii(4, segments)
        for _ in range(300):
            flipped = rng.choice(64, 4, replace=False)
            per = [sum(a <= b < a + w for b in flipped) for a, w in cuts]
            assert any(n <= r for n, r in zip(per, radii, strict=True))


def test_dense_group_gives_few_links(spark):
    """All fingerprints of two bits around one point: links stay far below all pairs, the group is whole."""
    points = [(1 << i) | (1 << j) for i in range(40) for j in range(i)]
    df = spark.createDataFrame([([p],) for p in points], "fp array<long>")
    links = S.links(df, 4, 3)
    assert links.count() < 20 * len(points)
    assert S.near_groups(df, 4, 3).select("root").distinct().count() == 1


def test_null_ids_repeated_rows_and_extra_columns(spark, docs_of):
    docs = docs_of((None, "a b c d e"), (None, "a b c d e"), (3, "x y z"), (3, "x y z"), (9, None), extra=True)
    got = sorted(map(str, ((r["doc_id"], r["component_id"]) for r in S.near_duplicates(docs).collect())))
    assert got == sorted(map(str, [(None, None), (None, None), (3, 3), (3, 3), (9, 9)]))
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "9", "None"]


def test_empty_table(spark, docs_of):
    assert S.near_duplicates(docs_of()).count() == 0
    assert S.drop_near_duplicates(docs_of()).count() == 0


def test_near_copies_go_and_others_stay(spark, docs_of):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(40)]
    copies = []
    for t in texts[:20]:
        parts = t.split()
        for at in rng.sample(range(300), 3):
            parts[at] = "other"
        copies.append(" ".join(parts))
    passage = " ".join(rng.choices(words, k=60))
    shared = [t + " " + passage for t in texts[20:30]]
    kept = {r["doc_id"] for r in S.drop_near_duplicates(docs_of(*texts[:20], *shared, *texts[30:], *copies)).collect()}
    assert kept == set(range(40))


def edited(rng, words, text, share):
    """The text with runs of words replaced until about ``share`` of its five-word shingles are new."""
    parts = text.split()
    for at in rng.sample(range(0, len(parts) - 1), max(1, int(share * len(parts) / 5))):
        parts[at] = rng.choice(words) + "x"
    return " ".join(parts)


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_dedup_against_brute_force(spark, docs_of):
    """Nearly every text with an earlier one at 0.8 or more goes, and none without one at 0.6."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    texts = []
    for _ in range(60):
        base = " ".join(rng.choices(words, k=rng.choice([30, 120, 400])))
        texts += [base] + [edited(rng, words, base, rng.uniform(0.0, 0.5)) for _ in range(4)]
    texts += ["", None, "a b", "a  B", "one two three four", *[texts[0]] * 30, "long " * 100_000, "Long " * 100_000]
    sets = [shingles(t) for t in texts]
    nearest = [max((jaccard(sets[i], sets[j]) for j in range(len(texts)) if j != i), default=0) for i in range(len(texts))]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    due = {i for i in range(len(texts)) if find(i) != i}
    names = "fp a b key label row_1 row_2 first root n last __text".split()
    docs = docs_of(*texts).select("*", *[F.lit("x").alias(n) for n in names])
    kept = {r["doc_id"] for r in S.drop_near_duplicates(docs).collect()}
    assert len(due - kept) >= 0.95 * len(due) and len(due) > 60
    assert all(nearest[i] >= 0.6 for i in set(range(len(texts))) - kept)
    assert {0, 300, len(texts) - 2} <= kept


def test_search_plan_finds_pairs_at_the_limit():
    """Of random bit strings that differ as texts at 0.8 do, nine of ten are looked up and near; at 0.85 nearly all."""
    rng = np.random.default_rng(4)
    for n in (1000, 1 << 23):
        index_words, segments, distance = S.search_plan(n, 0.8)
        for similarity, least in ((0.8, 0.9), (0.85, 0.98)):
            flips = rng.random((4000, 512)) < np.arccos(2 * similarity / (1 + similarity)) / np.pi
            found = np.zeros(4000, bool)
            for at, width in S.segment_bits(64 * index_words, segments):
                found |= flips[:, at : at + width].sum(axis=1) <= 1
            assert (found & (flips.sum(axis=1) <= distance)).mean() >= least


def test_search_plan_is_the_same_at_every_size():
    """Else a pair that stays in a small table goes in a large one, or the other way round."""
    assert len({S.search_plan(n, 0.8) for n in (0, 1000, 1 << 22, (1 << 22) + 1, 1 << 40)}) == 1
    assert len({S.search_plan(n, 0.9, words=4) for n in (1, 1 << 23)}) == 1


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3)]
    roots = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 160), 100)}
