"""Toxic passages by maximum-scoring segments.

Token scores are log-odds of toxic against other text under an informative Dirichlet prior. One linear scan
finds all maximal-scoring segments of a text; extreme-value theory says how large a score chance alone
would reach in a text of that length, and a text's score is a logistic function of the logarithm of what its
segments have beyond that.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightframe.llm.common import stored
from nightframe.llm.labelled import training_texts

#: Every ASCII character that is no letter or digit separates tokens; letters are lower-cased.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def maximal_segments(hits: list[tuple[int, float]], n: int, background: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(start, end, score)`` of ``n`` tokens, in linear time.

    ``hits`` are the positions with a positive score; all others score ``background``, which is negative, so
    only hits can open or close a segment. Candidates are kept with the cumulative score before and at their end; a new
    one joins an earlier one whose left sum is smaller unless that one's right sum is at least as large.
    """
    candidates: list[list[float]] = []  # start, end, left sum, right sum
    total, last = 0.0, -1
    for at, score in hits:
        total += background * (at - last - 1)
        new = [at, at + 1, total, total + score]
        total, last = total + score, at
        while True:
            j = len(candidates) - 1
            while j >= 0 and candidates[j][2] >= new[2]:
                j -= 1
            if j < 0 or candidates[j][3] >= new[3]:
                candidates.append(new)
                break
            new = [candidates[j][0], new[1], candidates[j][2], new[3]]
            del candidates[j:]
    return [(int(a), int(b), right - left) for a, b, left, right in candidates]


@dataclass(frozen=True)
class Model:
    weights: dict[bytes, float]
    background: float
    rate: float  # lambda of the extreme-value distribution
    extent: float  # K
    bias: float
    slope: float
    level: float  # largest chance probability of a significant segment

    def segments(self, text: bytes | None) -> tuple[int, list[tuple[int, int, float, float]]]:
        """Number of tokens, and the significant segments ``(start, end, score, excess)``."""
        words = tokens(text)
        weights = self.weights
        hits = [(i, weights[w]) for i, w in enumerate(words) if w in weights]
        if not hits:
            return len(words), []
        floor = math.log(self.extent * max(len(words), 1))
        found = []
        for start, end, score in maximal_segments(hits, len(words), self.background):
            excess = self.rate * score - floor
            if -math.expm1(-math.exp(-excess)) <= self.level:
                found.append((start, end, score, excess))
        return len(words), found

    def score(self, found: list[tuple[int, int, float, float]]) -> float:
        x = self.bias + self.slope * math.log1p(sum(s[3] for s in found))
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def _token_counts(texts: DataFrame) -> DataFrame:
    """``token, y0, y1``: after how many different tokens a token occurs in each class.

    Copies of a text repeat its contexts, so a group of near-copies counts about once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = tokens(value)
                pairs = list(set(zip(words, map(zlib.crc32, [b"", *words[:-1]]), strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w for w, _ in pairs], pa.binary()),
                        pa.array([h for _, h in pairs], pa.int64()),
                        pa.array([1 - y] * len(pairs), pa.int64()),
                        pa.array([y] * len(pairs), pa.int64()),
                    ],
                    names=["token", "after", "y0", "y1"],
                )

    met = texts.select("text", "y").mapInArrow(run, "token binary, after long, y0 long, y1 long")
    once = met.groupBy("token", "after").agg(F.max("y0").alias("y0"), F.max("y1").alias("y1"))
    return once.groupBy("token").agg(F.sum("y0").alias("y0"), F.sum("y1").alias("y1"))


def fit(
    texts: DataFrame, prior: float = 100.0, least: float = 0.5, significance: float = 5.0, effect: float = 1.5, share: float = 0.05, level: float = 0.05
) -> Model:
    """A model from ``text, y`` (:func:`training_texts` bounds them).

    A token's prior is ``prior`` times its frequency in both classes, ``least`` at least. It gets a score if its counts
    deviate from chance by ``significance`` standard deviations
    and its log-odds is ``effect`` or more. ``share`` is how many tokens of a toxic passage are expected to
    have a score; it sets the background's. Without a toxic or another text every score is 0.5.
    """
    texts = stored(texts, "toxicity-training")
    counts = stored(_token_counts(texts), "toxicity-counts")
    sizes = counts.agg(F.sum("y0").alias("n0"), F.sum("y1").alias("n1")).first()
    n0, n1 = sizes["n0"] or 0, sizes["n1"] or 0
    if not n0 or not n1:
        return Model({}, -1.0, 1.0, 1.0, 0.0, 0.0, level)
    a = F.greatest(F.lit(prior) * (F.col("y0") + F.col("y1")) / F.lit(n0 + n1), F.lit(least))
    odds = F.log((F.col("y1") + a) / (n1 + prior - F.col("y1"))) - F.log((F.col("y0") + a) / (n0 + prior - F.col("y0")))
    # deviance from the same frequency in both classes; unlike a standard error it holds for small counts
    one, two = F.col("y1"), F.col("y0")
    expected = (one + two) * F.lit(n1 / (n0 + n1))
    deviance = 2 * (one * F.log(one / expected) + F.when(two > 0, two * F.log(two / (one + two - expected))).otherwise(0.0))
    found = counts.where("y1 > 0").select("token", "y0", "y1", odds.alias("odds"), deviance.alias("deviance"))
    rows = found.where((F.col("deviance") >= significance**2) & (F.col("odds") >= effect)).collect()  # bounded by the sample
    held1 = sum(r["y1"] for r in rows) / n1
    held0 = sum(r["y0"] for r in rows) / n0
    # in a passage the scored tokens share `share` among them as they do in toxic texts
    lift = math.log(max(share / max(held1, 1e-12), 1.0))
    weights = {bytes(r["token"]): float(r["odds"]) + lift for r in rows}
    background = math.log((1 - share) / (1 - min(held0, share / 2)))
    draft = Model(weights, background, 1.0, 1.0, 0.0, 1.0, 1.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(y, *draft.segments(t)) for t, y in zip(batch["text"], batch["y"], strict=True)]
            yield pd.DataFrame([(y, n, [s[2] for s in found]) for y, n, found in rows], columns=["y", "n", "scores"])

    seen = texts.mapInPandas(run, "y int, n long, scores array<double>").toPandas()  # a row per training text
    # K such that K N exp(-lambda s) is the number of segments that other texts have, s the least score of one
    other = seen[seen["y"] == 0]
    chance = [s for scores in other["scores"] for s in scores]
    length = max(float(other["n"].sum()), 1.0)
    extent = (0.5 + len(chance)) * math.exp(min(weights.values(), default=0.0)) / length
    draft = Model(weights, background, 1.0, extent, 0.0, 1.0, level)
    x = np.array([math.log1p(_excess(draft, int(n), scores)) for n, scores in zip(seen["n"], seen["scores"], strict=True)])
    bias, slope = _logistic(x, seen["y"].to_numpy(float))
    return Model(weights, background, 1.0, extent, bias, slope, level)


def _excess(model: Model, n: int, scores) -> float:
    floor = math.log(model.extent * max(n, 1))
    each = [model.rate * s - floor for s in scores]
    return sum(e for e in each if -math.expm1(-math.exp(-e)) <= model.level)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> tuple[float, float]:
    """Bias and slope by Newton's method; the penalty keeps separable classes finite."""
    scale = max(float(np.abs(x).max(initial=0.0)), 1e-9)
    a = np.stack([np.ones_like(x), x / scale], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty * np.eye(2), a.T @ (y - p) - penalty * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1] / scale)


def scores(text: Column, model: Model) -> Column:
    """The toxicity of a text, as a column that keeps rows as they are."""

    @F.pandas_udf(T.DoubleType())
    def score(values: pd.Series) -> pd.Series:
        return pd.Series([model.score(model.segments(v)[1]) for v in values], dtype="float64")

    return score(text.cast("binary"))


def passages(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, score`` and ``segments``: every significant passage as token range, score and excess over chance.

    Null and empty texts have no passages and score as any text without one. Repeated rows and null ids stay.
    Extra columns are ignored. Texts of any length are scanned whole; an empty table has no rows.
    """
    narrow = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    part = "start: long, end: long, score: double, excess: double"
    schema = T.StructType(
        [
            narrow.schema.fields[0],
            T.StructField("score", T.DoubleType(), False),
            T.StructField("segments", T.ArrayType(T.StructType.fromDDL(part))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("excess", pa.float64())]))
        for batch in batches:
            found = [model.segments(t)[1] for t in batch.column(1).to_pylist()]
            spans = [[dict(zip(("start", "end", "score", "excess"), s, strict=True)) for s in each] for each in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(model.score, found), pa.float64()), pa.array(spans, kind)],
                names=["doc_id", "score", "segments"],
            )

    return narrow.mapInArrow(run, schema)


def learn(
    docs: DataFrame, labels: DataFrame, learnable: Column | None = None, rows: int = 20_000, label: str = "toxic"
) -> Model:
    """A model from at most ``rows`` labelled documents whose id fulfils ``learnable``."""
    return fit(training_texts(docs, labels, label, F.lit(True) if learnable is None else learnable, rows))
