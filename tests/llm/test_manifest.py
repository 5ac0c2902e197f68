import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from nightframe.llm import manifest
from nightframe.llm.common import table
from nightframe.llm.registry import op11_manifest

TEXT = "doc_id long, text string, lang string, source string, n_chars long"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, lower=False):
    text = r["text"]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return h("".join(map(enc, [r["doc_id"], r["source"], r["lang"], r["n_chars"], text])))


def tree(nodes):
    """Root and, for each leaf, its siblings of every level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([h("".join(x[i : i + 16])) for i in range(0, len(x), 16)])
    paths = []
    for i in range(len(nodes)):
        path, at = [], i
        for x in levels[:-1]:
            s = at - at % 16
            path.append(("".join(x[s:at]), "".join(x[at + 1 : s + 16])))
            at //= 16
        paths.append(path)
    return levels[-1][0], paths


def brute(rows):
    """Every row's result, from sorted lists."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    subs, held = [], []
    for k in keys:
        rows = sorted(groups[k], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        sub, paths = tree([leaf(r) for r in rows])
        subs.append(sub)
        held.append((rows, paths))
    root, tops = tree(subs)
    out = []
    for (rows, paths), sub, top in zip(held, subs, tops, strict=True):
        for r, path in zip(rows, paths, strict=True):
            d = r["doc_id"]
            node = leaf(r, lower=d is not None and zlib.crc32(str(d).encode()) % 5 == 0)
            for left, right in path + top:
                node = h(left + node + right)
            proof = h("".join(a + b for a, b in path + top))
            out.append((d, leaf(r), sub, root, proof, node, node == root))
    return sorted(out, key=str)


def result(df):
    c = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    return sorted([tuple(r[x] for x in c) for r in df.collect()], key=str)


def run(spark, df, tmp_path):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return op11_manifest(spark, str(tmp_path))


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    sources = [f"s{i}" for i in range(18)] + ["é", "", None]
    rows = []
    for i in range(1500):
        source = "s0" if rng.random() < 0.4 else rng.choice(sources)
        text = rng.choice([None, "", "A b\nC", f"Text {i}", "ü" * 50, f"lower {i}"])
        rows.append({"doc_id": rng.choice([i, i, -i, i << 33]), "text": text, "lang": rng.choice(["en", None]), "source": source, "n_chars": rng.choice([None, i])})
    rows += [{"doc_id": None, "text": f"N {i % 7}", "lang": None, "source": rng.choice(["s0", None]), "n_chars": 1} for i in range(60)]
    rows += [{"doc_id": 77, "text": f"Same id {i % 11}", "lang": "en", "source": "s0", "n_chars": 1} for i in range(90)]
    rows.append({"doc_id": 5, "text": "Long " * 300_000, "lang": "en", "source": "lone", "n_chars": 9})
    rng.shuffle(rows)
    df = spark.createDataFrame([[r[c] for c in "doc_id text lang source n_chars".split()] for r in rows], TEXT)
    names = "tree place chunk low lot page leaf claimed node above size block root rows id member verified shift".split()
    df = df.select("*", *[F.lit("x").alias(n) for n in names])
    found = result(run(spark, df, tmp_path))
    want = brute(rows)
    # equal rows share their results among them, in any order
    assert found == want


def test_sizes(spark):
    sizes = (1, 15, 16, 17, 256, 257, 4096, 4097, 9000)
    rows = [{"doc_id": i * 3, "text": None, "lang": "A", "source": f"n{n}", "n_chars": i} for n in sizes for i in range(n)]
    df = spark.createDataFrame([[r[c] for c in "doc_id text lang source n_chars".split()] for r in rows], TEXT)
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    claimed = F.when(crc, manifest.leaf_of(*[F.col(f) for f in manifest.FIELDS]))
    assert result(manifest.manifest(df, claimed=claimed)) == brute(rows)


def test_one_row_repeated_over_several_arrays(spark):
    rows = [{"doc_id": 4, "text": None, "lang": "b", "source": "x", "n_chars": 2}] * 9000
    rows += [{"doc_id": i, "text": None, "lang": "b", "source": "x", "n_chars": 2} for i in range(9)]
    df = spark.createDataFrame([[r[c] for c in "doc_id text lang source n_chars".split()] for r in rows], TEXT)
    assert result(manifest.manifest(df)) == brute(rows)


def test_rows_of_one_id_in_lots(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LOT", 64)
    rows = [{"doc_id": i % 2 or None, "text": str(i), "lang": "b", "source": "x", "n_chars": 2} for i in range(700)]
    df = spark.createDataFrame([[r[c] for c in "doc_id text lang source n_chars".split()] for r in rows], TEXT)
    assert result(manifest.manifest(df)) == brute(rows)


def test_empty(spark, tmp_path):
    assert run(spark, spark.createDataFrame([], TEXT), tmp_path).collect() == []


def test_ranks_of_bitmaps():
    rng = np.random.default_rng(1)
    for n in (1, 4095, 4096, 4097, 40_000, 65_536):
        lows = np.sort(rng.choice(65_536, n, replace=False))
        c = manifest._container(lows)
        assert len(c) <= 8192 and (manifest._lows(c) == lows).all()
        asked = rng.integers(0, 65_536, 999)
        assert (manifest.ranks(c, manifest.popcounts(c), asked) == np.searchsorted(lows, asked)).all()


def test_any_change_is_found(spark, sf):
    df = op11_manifest(spark, sf)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    joined = df.join(docs, "doc_id")
    changed = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & F.col("text").rlike("[A-Z]")
    assert joined.where(changed).count() > 0
    assert joined.where(F.coalesce(changed, F.lit(False)) == F.col("verified")).count() == 0
