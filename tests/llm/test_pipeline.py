"""The pipeline's stages on a small corpus with planted cases, and the registry."""

import random

import pytest

import corpus_pipeline as P
from nightframe.llm.common import stored


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("ba", "ko", "ri", "tu", "se", "no") for b in ("len", "mas", "ton", "ser", "vid", "ger")]
    base = [" ".join(rng.choices(words, k=rng.randint(80, 200))) for _ in range(300)]
    texts = list(base)
    toxic = dict.fromkeys(range(300), 0)
    for i in range(0, 60):
        parts = texts[i].split()
        for at in rng.sample(range(len(parts)), 4):
            parts[at] = rng.choice(["vile", "nasty"])
        texts[i], toxic[i] = " ".join(parts), 1
    texts += [texts[100], texts[101].replace(" ", "  "), " ".join(["other", *texts[102].split()[1:]])]
    texts += ["start token = abcdef123456 end " + base[103][::-1], None, None, ""]
    rows = [(i, t, rng.choice(["en", "de"]), f"src{i % 12}", len(t or "")) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(sorted(toxic.items()), "doc_id long, toxic int").selectExpr(
        "doc_id", "1 AS quality", "toxic"
    ).write.parquet(f"{folder}/labels.parquet")
    return folder, texts


def test_stages(spark, corpus):
    folder, texts = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        seen[name] = docs.collect()
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    ids = {name: {r["doc_id"] for r in rows} for name, rows in seen.items()}
    assert ids["toxicity"] == set(range(60, 307))
    assert ids["simhash_near_dedup"] == ids["toxicity"] - {300, 301, 302, 305, 306}
    clean = {r["doc_id"]: r for r in seen["secret_scan"]}
    assert set(clean) == ids["simhash_near_dedup"]
    assert clean[303]["text"].startswith("start [SECRET] end") and clean[303]["n_chars"] == len(clean[303]["text"])
    assert all(r["text"] == texts[i] for i, r in clean.items() if i != 303)
    assert ids["mixing"] < set(clean) and len(seen["mixing"]) == len(ids["mixing"])
    assert ids["packing"] == ids["mixing"]


def test_run_gives_the_last_stage(spark, sf):
    assert P.run(spark, sf).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    ]


def test_stages_on_an_empty_table(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
        docs = spark.createDataFrame([], docs.schema)


def test_registry():
    import __spark_entry__ as entry
    from nightframe.llm import registry as R

    names = [q.split("_")[0] for q in R.QUERIES]
    assert names == [f"op{n}" for n in range(1, 14)]
    assert set(R.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(R.ORACLE) <= set(entry.oracle_sql())
