"""Quality rules: counts per text, and a hashed n-gram log-likelihood ratio of target to raw corpus.

The ratio compares two multinomials over hashed unigrams and bigrams, one of trusted documents and one of
all documents, and is divided by the number of n-grams of a text. A fixed threshold decides for every
document; nothing is drawn at random.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPACES = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
#: Words and runs of marks, on UTF-8 bytes.
_TOKENS = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^\s0-9A-Za-z_\x80-\xff]+")

BASE = T.StructType(
    [
        T.StructField(name, T.LongType(), False)
        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    ]
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three words that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    _, pair = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
    twice = count[window] > 1
    inside = np.zeros(n, bool)
    for i in range(3):
        inside[i : n - 2 + i] |= twice
    return int(inside.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a UTF-8 text."""
    words = text.split()
    solid = text.translate(None, _SPACES)
    chars = len(solid.decode("utf-8", "replace"))
    symbols = len(solid) - len(solid.translate(None, _SYMBOLS))
    seen: set[bytes] = set()
    duplicates = 0
    for line in text.split(b"\n"):
        if line.strip(_SPACES):
            duplicates += line in seen
            seen.add(line)
    return len(words), chars, symbols, duplicates, repeated_words(words)


def hashed_ngrams(text: bytes, buckets: int) -> np.ndarray:
    """Buckets of the lower-cased text's unigrams, then of its bigrams."""
    h = np.array([zlib.crc32(t) for t in _TOKENS.findall(text.lower())], np.uint64)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = np.concatenate([h * np.uint64(0x9E3779B97F4A7C15), pairs ^ (pairs >> np.uint64(29))])
    mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def ngram_counts(docs: DataFrame, text: Column, trusted: Column, buckets: int) -> DataFrame:
    """``bucket, raw, target`` over all rows; each task sends at most one row per bucket."""
    narrow = docs.select(text.cast("binary").alias("text"), F.coalesce(trusted, F.lit(False)).alias("trusted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for value, good in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(hashed_ngrams(value or b"", buckets), minlength=buckets)
                counts[0] += found
                if good:
                    counts[1] += found
        held = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(counts[0][held]), pa.array(counts[1][held])], names=["bucket", "raw", "target"]
        )

    sent = narrow.mapInArrow(run, "bucket long, raw long, target long")
    return sent.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int, smoothing: float = 1.0) -> np.ndarray:
    """Log ratio of target to raw probability of each bucket; zero everywhere without a trusted text."""
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for row in counts.toLocalIterator():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.sum():
        return np.zeros(buckets, np.float32)
    # the prior of the target is the raw distribution, so that a bucket it never saw isn't impossible
    p = (raw + smoothing) / (raw.sum() + smoothing * buckets)
    q = (target + smoothing) / (target.sum() + smoothing * buckets)
    return np.log(q / p).astype(np.float32)


def trusted_ids(labels: DataFrame, rows: int, id: str = "doc_id", label: str = "quality") -> DataFrame:
    """Ids labelled 1, at most ``rows`` of them, chosen by a hash of the id."""
    good = labels.where(F.col(label) == 1).where(F.col(id).isNotNull()).select(F.col(id).alias("trusted_id")).distinct()
    return good.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(rows)


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    buckets: int = 1 << 14,
    threshold: float = -0.25,
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, the base counts, ``base_failed``, ``llr`` and ``kept``.

    ``trusted`` has the target's ids in ``trusted_id``, distinct and few enough to be sent to every task
    (:func:`trusted_ids` bounds them). The raw multinomial counts every document. ``llr`` is
    the mean log ratio of a text's n-grams, 0 without any; a text at or above ``threshold`` is kept unless the base
    rules fail it.

    A null or empty text has no words and fails the base rules. Null ids are never trusted. Repeated rows
    stay and count as often as they occur. Extra columns are ignored. Without any trusted text ``llr`` is 0.
    """
    flagged = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(trusted.withColumn("trusted", F.lit(True))), F.col("doc_id") == F.col("trusted_id"), "left"
    )
    ratios = log_ratios(ngram_counts(flagged, F.col("text"), F.col("trusted"), buckets), buckets)
    narrow = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    schema = T.StructType(
        [narrow.schema.fields[0], *BASE.fields, T.StructField("base_failed", T.BooleanType(), False),
         T.StructField("llr", T.DoubleType(), False), T.StructField("kept", T.BooleanType(), False)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1).to_pylist():
                value = value or b""
                base = base_counts(value)
                failed = base[0] < min_words or 100 * base[4] > max_repeat_percent * base[0]
                grams = hashed_ngrams(value, buckets)
                llr = float(ratios[grams].mean(dtype=np.float64)) if len(grams) else 0.0
                rows.append((*base, failed, llr, not failed and llr >= threshold))
            columns = list(zip(*rows, strict=True)) if rows else [()] * (len(schema) - 1)
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=schema.names
            )

    return narrow.mapInArrow(run, schema)
