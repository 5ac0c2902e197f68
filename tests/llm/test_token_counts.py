import os
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nightframe.llm import token_counts
from nightframe.llm.registry import op13_token_counts

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


def test_query_on_the_table(spark, sf, library):
    found = op13_token_counts(spark, sf)
    assert found.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    want = Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n = len(library.encode(r["text"] or ""))
        want[r["doc_id"], len((r["text"] or "").encode()), n, n > 4096] += 1
    assert Counter(tuple(r) for r in found.collect()) == want


ODD = [None, "", " ", "  ", "a ", " a", "▁", "a▁b", "a b", "\t\n", "<s> </s><unk>", "a\0b", "é ﬁ 漢字 🙂", "x" * 300, "word " * 400_000, "ab" * 200_000]


def test_odd_and_repeated_texts(spark, docs_of, tmp_path, library):
    texts = [(i // 2 if i else None, t) for i, t in enumerate(ODD + ODD[:6])]
    docs = docs_of(*texts, extra=True).select("*", *[F.lit("z").alias(c) for c in "content packed size n_tokens n_bytes text_".split()])
    found = token_counts.count_tokens(docs, str(tmp_path), MODEL).collect()
    want = Counter((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in texts)
    assert Counter(tuple(r) for r in found) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab ▁\t\n .éﬁ漢🙂0Ⅷ 　​<s>") | st.characters(exclude_categories=["Cs"])), max_size=4))
def test_counts_are_the_library_s(texts):
    model = token_counts.tokenizer(MODEL)
    assert model.by_words
    assert model.count(texts) == [len(x) for x in sentencepiece_of().encode(texts)]


def sentencepiece_of(held=[]):  # noqa: B006
    if not held:
        held.append(sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL)))
    return held[0]


def stored_rows(spark, cache):
    return spark.read.option("recursiveFileLookup", True).parquet(str(cache)).count()


def test_only_new_texts_are_encoded(spark, docs_of, tmp_path, monkeypatch):
    first = sorted(token_counts.count_tokens(docs_of("one", "two", "two", "a b"), str(tmp_path), MODEL).collect())
    assert stored_rows(spark, tmp_path) == 3
    batches = sum(len(d) for _, d, _ in os.walk(tmp_path))
    # a space and its mark are the same to the model
    again = token_counts.count_tokens(docs_of("two", "one", "a▁b"), str(tmp_path), MODEL).collect()
    assert stored_rows(spark, tmp_path) == 3 and sum(len(d) for _, d, _ in os.walk(tmp_path)) == batches
    assert [(r["doc_id"], r["n_tokens"]) for r in sorted(again)] == [(0, first[1]["n_tokens"]), (1, first[0]["n_tokens"]), (2, first[3]["n_tokens"])]
    # what is stored is what counts
    monkeypatch.setattr(token_counts, "SENT_BYTES", 0)
    more = token_counts.count_tokens(docs_of("three", "two", "three", *["four"] * 50), str(tmp_path), MODEL)
    assert more.count() == 53 and stored_rows(spark, tmp_path) == 5


def test_a_stored_count_is_taken(spark, docs_of, tmp_path):
    version = token_counts.tokenizer(MODEL).version
    digest = spark.range(1).select(F.unhex(F.sha2(F.lit("one"), 256)).alias("content"), F.lit(77).cast("long").alias("n_tokens"))
    digest.write.parquet(f"{tmp_path}/tokenizer={version}/a")
    digest.write.parquet(f"{tmp_path}/tokenizer={version}/b")  # another run has stored it too
    digest.write.parquet(f"{tmp_path}/tokenizer=other/a")
    found = token_counts.count_tokens(docs_of("one", "two"), str(tmp_path), MODEL).collect()
    assert [r["n_tokens"] for r in sorted(found)] == [77, 1]


def test_other_tokenizer_and_empty_table(spark, docs_of, tmp_path):
    model = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "one  two", "", None]
    found = token_counts.count_tokens(docs_of(*texts), str(tmp_path), "byte_bpe_50k.json").collect()
    assert [r["n_tokens"] for r in sorted(found)] == [len(model.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert token_counts.count_tokens(docs_of(*texts).limit(0), str(tmp_path), MODEL).collect() == []
