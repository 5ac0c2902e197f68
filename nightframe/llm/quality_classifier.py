"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded, gated attention weighs the passages of a bag, and the
weighted sum is scored. Only document labels are learnt from; the weights find the passages that matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightframe.llm.labelled import training_texts

#: Byte classes: capitals, small letters, digits, letters beyond ASCII, sentence marks, symbols, other marks.
_CLASSES = 7
_CLASS_OF = np.full(256, 6, np.uint8)
for _i, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), range(128, 256), b".,;:!?", b"#*$%&|<>")):
    _CLASS_OF[list(_bytes)] = _i
_PROJECTED = 16
FEATURES = _CLASSES + 5 + _PROJECTED


def passage_features(text: bytes | None, words_per_passage: int) -> np.ndarray:
    """One row of features per passage of consecutive words; a text without words has one row of zeros."""
    words = (text or b"").split()
    n = len(words)
    if not n:
        return np.zeros((1, FEATURES), np.float32)
    starts = np.arange(0, n, words_per_passage)
    sizes = np.diff(np.append(starts, n)).astype(np.float64)
    lengths = np.fromiter(map(len, words), np.int64, n)
    classes = _CLASS_OF[np.frombuffer(b"".join(words), np.uint8)]
    chars = np.add.reduceat(lengths, starts).astype(np.float64)
    # class counts of each passage: a bin for each pair of passage and class
    owner = np.repeat(np.arange(len(starts)), chars.astype(np.int64))
    shares = np.bincount(owner * _CLASSES + classes, minlength=_CLASSES * len(starts)).reshape(-1, _CLASSES) / chars[:, None]
    h = np.fromiter(map(zlib.crc32, words), np.uint64, n)
    first = np.zeros(n, bool)
    first[np.unique(h, return_index=True)[1]] = True
    pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:]
    again = np.ones(n, bool)
    again[np.unique(pair, return_index=True)[1]] = False
    again[-1] = False
    mixed = h * np.uint64(0xBF58476D1CE4E5B9)
    bits = np.unpackbits((mixed >> np.uint64(32)).astype("<u4").view(np.uint8).reshape(n, 4)[:, :2], axis=1)
    told = np.add.reduceat(bits.astype(np.float32) * 2 - 1, starts, axis=0) / sizes[:, None]
    bare = np.add.reduceat(lengths == 1, starts, dtype=np.float64)
    rows = [
        shares,
        (chars / sizes)[:, None] / 10,
        (np.add.reduceat(first, starts, dtype=np.float64) / sizes)[:, None],
        (np.add.reduceat(again, starts, dtype=np.float64) / sizes)[:, None],
        (bare / sizes)[:, None],
        np.log1p(sizes)[:, None],
        told,
    ]
    return np.concatenate(rows, axis=1).astype(np.float32)


@dataclass
class Model:
    """Weights of encoder, gated attention and score, and the scaling of the features."""

    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]
    words_per_passage: int

    def attention(self, bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The score of each bag and the attention of each passage."""
        x = (np.concatenate(bags) - self.mean) / self.scale
        starts = np.cumsum([0, *map(len, bags[:-1])])
        made = _forward(self.w, x, starts, np.array(list(map(len, bags))))
        return made["p"], made["a"]

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return self.attention([passage_features(t, self.words_per_passage) for t in texts])[0].astype(np.float64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w, x, starts, sizes) -> dict[str, np.ndarray]:
    h = np.maximum(x @ w["encode"] + w["encode_bias"], 0)
    t, g = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["gate"])
    e = (t * g) @ w["attend"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(h * a[:, None], starts, axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["score"] + w["score_bias"])}


def _gradients(w, x, starts, sizes, y) -> dict[str, np.ndarray]:
    """Of the mean log loss over the bags."""
    m = _forward(w, x, starts, sizes)
    d = (m["p"] - y) / len(y)
    dz = np.repeat(d[:, None] * w["score"], sizes, axis=0)
    da = (dz * m["h"]).sum(axis=1)
    de = m["a"] * (da - np.repeat(np.add.reduceat(m["a"] * da, starts), sizes))
    tg = de[:, None] * w["attend"]
    dt, dg = tg * m["g"] * (1 - m["t"] ** 2), tg * m["t"] * m["g"] * (1 - m["g"])
    dh = (dz * m["a"][:, None] + dt @ w["tanh"].T + dg @ w["gate"].T) * (m["h"] > 0)
    return {
        "encode": x.T @ dh, "encode_bias": dh.sum(axis=0), "tanh": m["h"].T @ dt, "gate": m["h"].T @ dg,
        "attend": (m["t"] * m["g"]).T @ de, "score": m["z"].T @ d, "score_bias": d.sum(),
    }


def fit(
    texts: list[bytes], y: np.ndarray, words_per_passage: int = 64, width: int = 32, hidden: int = 16,
    epochs: int = 40, batch: int = 128, rate: float = 0.003, decay: float = 1e-4, seed: int = 7,
) -> Model:
    """Trains on labelled texts by Adam; the same texts in the same order give the same model.

    Without texts of both classes every score is the share of label 1, or one half without any text.
    """
    rng = np.random.default_rng(seed)
    bags = [passage_features(t, words_per_passage) for t in texts]
    every = np.concatenate([*bags, np.zeros((1, FEATURES), np.float32)])
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    shapes = {
        "encode": (FEATURES, width), "encode_bias": (width,), "tanh": (width, hidden), "gate": (width, hidden),
        "attend": (hidden,), "score": (width,), "score_bias": (),
    }
    w = {k: np.asarray(rng.normal(0, 1 / np.sqrt(s[0] if s else 1), s) * (len(s) == 2), float) for k, s in shapes.items()}
    w["attend"], w["score"] = rng.normal(0, 0.25, hidden), rng.normal(0, 0.25, width)
    share = float(y.mean()) if len(y) else 0.5
    w["score_bias"] = np.asarray(np.log((share + 1e-3) / (1 - share + 1e-3)))
    if len(y) and 0 < share < 1:
        bags = [(b - mean) / scale for b in bags]
        m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(bags), batch):
                chosen = order[at : at + batch]
                sizes = np.array([len(bags[i]) for i in chosen])
                x = np.concatenate([bags[i] for i in chosen])
                grads = _gradients(w, x, np.cumsum(np.append(0, sizes[:-1])), sizes, y[chosen])
                step += 1
                for k, g in grads.items():
                    g = g + decay * w[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g**2
                    w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    else:
        w["score"] = np.zeros(width)
    return Model(mean, scale, w, words_per_passage)


def learn(
    docs: DataFrame, labels: DataFrame, learnable: Column | None = None, rows: int = 6000, label: str = "quality", **options
) -> Model:
    """A model from at most ``rows`` labelled documents whose id fulfils ``learnable``; these reach the driver."""
    texts = training_texts(docs, labels, label, F.lit(True) if learnable is None else learnable, rows)
    found = sorted((bytes(r["text"]), r["y"]) for r in texts.toLocalIterator())
    return fit([t for t, _ in found], np.array([y for _, y in found], float), **options)


def scores(text: Column, model: Model) -> Column:
    """The quality of a text, as a column that keeps rows as they are; null and empty texts are scored too."""

    @F.pandas_udf(T.DoubleType())
    def score(values: pd.Series) -> pd.Series:
        return pd.Series(model.scores(list(values)), dtype="float64")

    return score(text.cast("binary"))


def judge(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``score`` and ``attention``, the weight of each passage.

    Null and empty texts have one passage without words. Null ids and repeated rows stay. Extra columns are ignored. Texts of any length are
    read whole, passage by passage; an empty table has no rows.
    """
    narrow = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    schema = T.StructType(
        [narrow.schema.fields[0], T.StructField("score", T.DoubleType()), T.StructField("attention", T.ArrayType(T.FloatType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                bags = [passage_features(t, model.words_per_passage) for t in part.column(1).to_pylist()]
                p, a = model.attention(bags)
                offsets = pa.array(np.cumsum([0, *map(len, bags)]).astype(np.int32))
                weights = pa.ListArray.from_arrays(offsets, pa.array(a.astype(np.float32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(p.astype(np.float64)), weights], names=["doc_id", "score", "attention"]
                )

    return narrow.mapInArrow(run, schema)
