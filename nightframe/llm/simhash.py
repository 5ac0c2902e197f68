"""SimHash near-duplicates by multi-index hashing.

A fingerprint is an array of 64-bit words. It is cut into segments; by the pigeonhole principle two
fingerprints within the distance agree in at least one segment up to that segment's small radius, so
every link is found by enumerating the Hamming ball of that radius around each segment, fetching the
table rows with those segment values and checking the complete distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightframe.llm.common import checkpoint, row_hashes
from nightframe.llm.components import connected_components

_BLOCK = 1 << 14
_GOLDEN = 0x9E3779B97F4A7C15


def _further_words(h: np.ndarray, words: int) -> np.ndarray:
    """``words`` columns of hash bits: the hash itself, then bits mixed from it."""
    columns = [h]
    for i in range(1, words):
        x = h + np.uint64(_GOLDEN * i % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        columns.append(x ^ (x >> np.uint64(31)))
    return np.stack(columns, axis=1)


def fingerprint(text: bytes | None, shingle: int = 4, words: int = 1) -> np.ndarray:
    """The fingerprint of one text, as ``words`` unsigned 64-bit numbers; zero without words."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(words, np.uint64)
    joined = b" ".join(tokens)
    n = max(1, len(tokens) - shingle + 1)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n]
    ends = ends[-n:]
    ones = np.zeros(64 * words, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        cut = zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist(), strict=True)
        h = np.array([digest(joined[s:e], 42) for s, e in cut], np.uint64)
        bits = np.unpackbits(_further_words(h, words).view(np.uint8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n, bitorder="little").view(np.uint64)


def fingerprints(docs: DataFrame, keys: list[Column], text: str = "text", shingle: int = 4, words: int = 1) -> DataFrame:
    """The key columns and ``fp``; only they and the text reach Python."""
    narrow = docs.select(*keys, F.col(text).cast("binary").alias("__text"))
    schema = T.StructType([*narrow.schema.fields[:-1], T.StructField("fp", T.ArrayType(T.LongType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, shingle, words) for t in batch.column(batch.num_columns - 1).to_pylist()]
            flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)
            offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * words)
            fp = pa.ListArray.from_arrays(offsets, pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], fp], names=[*batch.schema.names[:-1], "fp"]
            )

    return narrow.mapInArrow(run, schema)


def segment_bits(bits: int, segments: int) -> list[tuple[int, int]]:
    """First bit and width of each segment; no segment crosses a 64-bit word."""
    if bits % 64 or bits < 64 or segments % (bits // 64):
        raise ValueError("bits must be whole 64-bit words, each cut into equally many segments")
    per_word = segments // (bits // 64)
    cuts = [64 * i // per_word for i in range(per_word + 1)]
    return [(64 * w + a, b - a) for w in range(bits // 64) for a, b in zip(cuts, cuts[1:], strict=False)]


def segment_radii(distance: int, segments: int) -> list[int]:
    """Radii that miss no pair: the first ``distance mod segments + 1`` segments get the quotient, the rest
    one less. If every segment differed by more than its radius, the whole would differ by more than the distance."""
    quotient, rest = divmod(distance, segments)
    return [quotient if i <= rest else quotient - 1 for i in range(segments)]


def _distance(a: list[str], b: list[str]) -> Column:
    total = F.lit(0)
    for x, y in zip(a, b, strict=True):
        total = total + F.bit_count(F.col(x).bitwiseXOR(F.col(y)))
    return total


def _words(prefix: str, words: int, of: str = "fp") -> list[Column]:
    """The words of a fingerprint as columns: they take less room in a shuffled row than an array."""
    return [F.col(of)[i].alias(f"{prefix}{i}") for i in range(words)]


def _names(prefix: str, words: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(words)]


def _bucket(segment: int, value: Column) -> Column:
    """A segment's number and value as one key."""
    return F.shiftleft(value, 8).bitwiseOR(F.lit(segment).cast("long"))


def links(
    distinct: DataFrame,
    distance: int,
    segments: int,
    words: int = 1,
    radii: list[int] | None = None,
    index_words: int | None = None,
) -> DataFrame:
    """``a, b``: links that give the same components as all pairs of fingerprints within ``distance``.

    ``distinct`` has one row per fingerprint in ``fp``. Links inside a dense group are quadratic in
    its size, so they are made in two steps. First every table row is linked with the smallest row of its
    bucket, if that is near enough; the groups found so far get a label. Then the balls are looked up,
    and a pair is returned only if its two labels differ: links within a known group add nothing.
    No bucket, probe or candidate is capped. The segments are cut from the first ``index_words`` words, by default all.
    """
    cuts = segment_bits(64 * (index_words or words), segments)
    radii = segment_radii(distance, segments) if radii is None else radii
    held = [i for i, r in enumerate(radii) if r >= 0]
    values = [
        F.shiftrightunsigned(F.col("fp")[at // 64], at % 64).bitwiseAND(F.lit((1 << width) - 1)) for at, width in cuts
    ]
    buckets = F.explode(F.array(*[_bucket(i, values[i]) for i in held])).alias("key")
    tables = distinct.select("fp", buckets)
    first = tables.groupBy("key").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    near = _distance(_names("p", words), _names("q", words)) <= distance
    stars = checkpoint(
        tables.withColumnRenamed("fp", "b")
        .join(first, "key")
        .where(F.col("a") != F.col("b"))
        .select("a", "b", *_words("p", words, "a"), *_words("q", words, "b"))
        .where(near)
        .select("a", "b")
        .distinct()
    )
    groups = connected_components(stars)
    root = F.coalesce("root", "fp")
    labelled = checkpoint(
        distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", (root[0] if words == 1 else F.xxhash64(root)).alias("label")
        )
    )

    def ball(i: int) -> Column:
        masks = F.array(*[F.lit(m).cast("long") for m in _ball(cuts[i][1], radii[i])])
        # of a pair whose segments differ, the smaller segment alone looks for the larger one
        looked_up = F.filter(masks, lambda m: values[i].bitwiseXOR(m) >= values[i])
        return F.transform(looked_up, lambda m: _bucket(i, values[i].bitwiseXOR(m)))

    probes = labelled.select(
        *_words("p", words), F.col("label").alias("label_p"), F.explode(F.concat(*map(ball, held))).alias("key")
    )
    rows = labelled.select(*_words("q", words), F.col("label").alias("label_q"), buckets.alias("key"))
    found = (
        probes.alias("x")
        .join(rows.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("label_p") != F.col("label_q")) & near)
        .select(F.array(*_names("p", words)).alias("a"), F.array(*_names("q", words)).alias("b"))
    )
    return stars.unionByName(found).distinct()


def _ball(width: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` bits of a segment."""
    return [sum(1 << i for i in chosen) for r in range(radius + 1) for chosen in combinations(range(width), r)]


def near_groups(
    prints: DataFrame,
    distance: int,
    segments: int,
    words: int = 1,
    radii: list[int] | None = None,
    index_words: int | None = None,
) -> DataFrame:
    """``fp, root`` for every distinct fingerprint: the group's smallest fingerprint."""
    distinct = checkpoint(prints.select("fp").distinct())
    groups = connected_components(links(distinct, distance, segments, words, radii, index_words))
    return distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def segments_for(n: int) -> int:
    """Segments of a 64-bit fingerprint among ``n``: every choice finds all links, long ones keep buckets small and short ones balls.

    Three segments of 21 bits need 45 probes a row and meet n / 2**21 rows with each; two of 32 bits need 562. They are even near 2**25.
    """
    return 3 if n <= 1 << 25 else 2


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4, segments: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp, component_id``.

    Fingerprints of 64 bits link at ``distance`` or fewer differing bits; ``component_id`` is the smallest id
    reachable. A null text has no words: fingerprint zero, linked like any other. A null id counts for no
    component; a component of null ids alone has a null ``component_id``. Repeated rows stay. Extra columns
    are ignored. Texts of any length are read whole; an empty table has no rows. ``segments`` changes speed alone; by default it follows from
    the number of rows, see ``segments_for``.
    """
    prints = checkpoint(fingerprints(docs, [F.col(id).alias("doc_id")], text, shingle))
    groups = near_groups(prints, distance, segments or segments_for(prints.count()))
    smallest = (
        prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
        .join(groups, "fp")
    )
    component = smallest.groupBy("root").agg(F.min("least").alias("component_id"))
    named = smallest.join(component, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def search_plan(n: int, similarity: float, words: int = 8) -> tuple[int, int, int]:
    """Words of a fingerprint that the index reads, its segments, and the distance in bits for fingerprints of ``words``.

    Each bit of two texts of Jaccard similarity s differs with a probability of arccos(2s / (1 + s)) over pi. The distance is that mean plus
    one and a half standard deviations, which 93 of 100 pairs at ``similarity`` keep. Which pairs are looked up decides which rows stay, so the
    plan is the same for any number ``n`` of fingerprints: of 512 bits, 16 segments of 16 bits; within one bit, a pair at 0.8 agrees in
    some segment in 99 of 100 cases. A fingerprint meets about n / 480 others by chance.
    """
    bits, part = 64 * words, float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    return words // 2, 2 * words, int(bits * part + 1.5 * np.sqrt(bits * part * (1 - part)))


def _packed_text(at: int):
    """Replaces column ``at``, text as bytes, by its compressed form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            values = batch.column(at).to_pylist()
            # the size goes before the compressed bytes
            packed = [None if v is None else len(v).to_bytes(8, "little") + (codec.compress(v, asbytes=True) if v else b"") for v in values]
            columns = list(batch.columns)
            columns[at] = pa.array(packed, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def _unpacked(value: bytes | None) -> bytes | None:
    if value is None:
        return None
    size = int.from_bytes(value[:8], "little")
    return pa.Codec("zstd").decompress(value[8:], size, asbytes=True) if size else b""


def _unpacked_text(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([_unpacked(v) for v in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8, words: int = 8
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group, the row with the smallest id stays.

    Texts whose shingles have about the ``similarity`` or more are near-duplicates: their fingerprints of ``64 * words`` bits differ in no more bits than
    ``search_plan`` says. Which rows stay is decided on ids and fingerprints; texts leave their tasks once, compressed, to meet what was decided.

    A null id comes last in its group, null and empty texts are one group, of repeated rows one stays, extra
    columns are returned as they are. Texts of any length are read whole. An empty table has no rows.
    """
    first, second = "__nf_row_1", "__nf_row_2"
    marked = docs.withColumns(dict(zip((first, second), row_hashes(docs), strict=True)))
    keys = [F.col(id).alias("doc_id"), F.col(first).alias("row_1"), F.col(second).alias("row_2")]
    prints = checkpoint(fingerprints(marked, keys, text, shingle, words))
    index_words, segments, distance = search_plan(prints.count(), similarity, words)
    groups = near_groups(prints, distance, segments, words, [1] * segments, index_words)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_1", "row_2")
    per_print = prints.groupBy("fp").agg(F.min(order).alias("first"))
    kept = per_print.join(groups, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = checkpoint(kept.select(F.col("first.row_1").alias(first), F.col("first.row_2").alias(second)))
    at = docs.columns.index(text)
    plain = [F.col(f"`{c}`").cast("binary").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    rows = marked.select(*plain, first, second)
    packed = rows.mapInArrow(_packed_text(at), rows.schema).join(kept, [first, second], "left_semi").dropDuplicates([first, second])
    whole = packed.drop(first, second)
    back = whole.mapInArrow(_unpacked_text(at), whole.schema)
    return back.select(*[F.col(f"`{c}`").cast(docs.schema[c].dataType).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
