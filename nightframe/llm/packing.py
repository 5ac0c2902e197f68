"""Packing of token sequences by linear grouping.

All lengths are whole numbers up to the capacity, so the histogram of lengths, with one count per length,
has all that a plan needs, however many documents there are. On it the driver groups the large lengths
into groups of equal cardinality, rounds each up to its group's largest, optimises how often each
configuration of rounded lengths is used by column generation, puts the actual lengths in their places and then
fills the small ones in by best fit. The plan is a bounded list of intervals: items ``lo`` to ``hi`` of a
length go to consecutive sequences at one offset. Spark numbers the items of each length and joins them with
the plan.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightframe.llm.common import stored

_ENCODERS: dict[tuple[str, str], object] = {}


def _encoder(ranks_file: str, model_file: str):
    """A function from text to ids as the model gives them. The rank file holds the same vocabulary and is encoded faster; a text with a
    string that the model takes for a token of its own, or one that the rank file's library can't take, goes to the model itself."""
    key = (ranks_file, model_file)
    if key not in _ENCODERS:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(ranks_file), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding(
            ranks_file, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        model = Tokenizer.from_file(public_tokenizers.path(model_file))
        added = [t.content for t in model.get_added_tokens_decoder().values()]

        def encode(text: str) -> list[int]:
            if not any(t in text for t in added):
                try:
                    return fast.encode_ordinary(text)
                except Exception:  # its pattern engine gives up on some very long runs
                    pass
            return model.encode(text, add_special_tokens=False).ids

        _ENCODERS[key] = encode
    return _ENCODERS[key]


def token_pieces(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    ranks_file: str = "byte_bpe_50k.tiktoken",
    model_file: str = "byte_bpe_50k.json",
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, piece, start, length, ids_crc32``, and ``ids`` if wanted.

    A document's ids are followed by ``end_id``. Of a document beyond the capacity the first piece takes the
    remainder and all others are full. A null or empty text is ``end_id`` alone. Repeated rows stay; a null id
    is kept; extra columns are ignored.
    """
    narrow = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    fields = [
        narrow.schema.fields[0],
        T.StructField("piece", T.IntegerType(), False),
        T.StructField("start", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("ids_crc32", T.LongType(), False),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False), False))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks_file, model_file)
        for batch in batches:
            rows, places = [], []
            for at, value in enumerate(batch.column(1)):
                ids = np.array([*encode(value.as_py() or ""), end_id], "<u4")
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    held = ids[a:b]
                    row = (piece, a, b - a, zlib.crc32(held.tobytes()))
                    rows.append((*row, held.astype(np.int32)) if with_ids else row)
                    places.append(at)
            columns = list(zip(*rows, strict=True)) if rows else [()] * (len(fields) - 1)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places, pa.int64()))]
                + [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)],
                names=schema.names,
            )

    return narrow.mapInArrow(run, schema)


# ---- the plan, on the histogram


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits, by dynamic programming over the capacity."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for i in np.flatnonzero(values > 0).tolist():
        size = int(sizes[i])
        for _ in range(capacity // size):  # each pass allows one item more of this size
            gain = best[:-size] + values[i]
            better = gain > best[size:] + 1e-12
            if not better.any():
                break
            best[size:][better] = gain[better]
            last[size:][better] = i
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while last[room] >= 0:
        counts[last[room]] += 1
        room -= int(sizes[last[room]])
    return float(values @ counts), counts


def optimal_configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each: the linear relaxation by column generation, rounded down.

    ``rounds`` bounds the pivots; a plan stopped early is valid, if not the shortest.
    """
    n = len(sizes)
    basis = np.diag(capacity // sizes).astype(np.int64)
    inverse = np.diag(1.0 / (capacity // sizes))
    x = demand / (capacity // sizes)
    for _ in range(rounds):
        duals = np.ones(n) @ inverse
        value, column = best_configuration(sizes, np.maximum(duals, 0), capacity)
        if value <= 1 + 1e-9:
            break
        direction = inverse @ column
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, direction, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        x = np.maximum(x - step * direction, 0)
        x[out] = step
        pivot = inverse[out] / direction[out]
        inverse = inverse - np.outer(direction, pivot)
        inverse[out] = pivot
        basis[:, out] = column
    return [(basis[:, j], int(x[j] + 1e-9)) for j in range(n) if int(x[j] + 1e-9)]


class _Sequences:
    """Sequences in classes of equal filling, and the intervals of items put into them."""

    def __init__(self, capacity: int):
        self.capacity, self.opened = capacity, 0
        self.free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: (first sequence, how many)
        self.rooms: list[int] = []
        self.plan: list[tuple[int, int, int, int, int]] = []  # length, lo, hi, first sequence, offset

    def hold(self, room: int, first: int, count: int) -> None:
        if room and count:
            if not self.free[room]:
                insort(self.rooms, room)
            self.free[room].append((first, count))

    def open(self, count: int) -> int:
        first, self.opened = self.opened, self.opened + count
        return first

    def put(self, length: int, lo: int, count: int, first: int, room: int) -> None:
        self.plan.append((length, lo, lo + count, first, self.capacity - room))

    def best_fit(self, length: int, lo: int, count: int) -> None:
        """``count`` items of a length, each into the fullest sequence that has room."""
        while count:
            i = bisect_left(self.rooms, length)
            if i == len(self.rooms):
                new = -(-count // (self.capacity // length))
                self.hold(self.capacity, self.open(new), new)
                continue
            room = self.rooms[i]
            first, many = self.free[room].pop()
            if not self.free[room]:
                self.rooms.pop(i)
            used = min(count, many)
            self.put(length, lo, used, first, room)
            self.hold(room, first + used, many - used)
            self.hold(room - length, first, used)
            lo, count = lo + used, count - used


def plan(
    histogram: dict[int, int], capacity: int, groups: int = 128, small: int = 16, share: float = 0.97, rounds: int = 3000
) -> tuple[int, list[tuple[int, int, int, int, int]]]:
    """``(sequences, intervals)`` for a histogram of lengths from 1 to ``capacity``.

    Lengths of at most ``capacity / small`` count as small. Full ones need no plan: each is a sequence.
    Rounding up leaves room beside the actual lengths. To use it, only ``share`` of each configuration's
    uses are taken and the smallest of its places stays open; the large lengths left over and then the small ones go
    into these rooms by best fit, longest first.
    """
    made = _Sequences(capacity)
    full = histogram.get(capacity, 0)
    if full:
        made.plan.append((capacity, 0, full, made.open(full), 0))
    large = [(l, histogram[l]) for l in sorted(histogram, reverse=True) if capacity // small < l < capacity]
    left = [[l, 0, n] for l, n in histogram.items() if n and l <= capacity // small]
    total = sum(n for _, n in large)
    if total:
        # equal-cardinality groups along the falling lengths: runs of (length, lo, count) per group
        runs: list[list[list[int]]] = [[] for _ in range(groups)]
        at = 0
        for length, n in large:
            lo = 0
            while lo < n:
                g = min(at * groups // total, groups - 1)
                end = -(-total * (g + 1) // groups)
                take = min(n - lo, max(1, end - at))
                runs[g].append([length, lo, take])
                lo, at = lo + take, at + take
        merged: dict[int, list[list[int]]] = {}
        for run in runs:
            if run:
                merged.setdefault(run[0][0], []).extend(run)
        sizes = np.array(sorted(merged, reverse=True), np.int64)
        demand = np.array([sum(r[2] for r in merged[s]) for s in sizes.tolist()], np.int64)
        for configuration, count in optimal_configurations(sizes, demand, capacity, rounds):
            places = np.repeat(sizes, configuration).tolist()
            _substitute(made, merged, places[:-1] if len(places) > 1 else places, int(count * share))
        left += [run for group in merged.values() for run in group]
    for length, lo, count in sorted(left, key=lambda run: (-run[0], run[1])):
        made.best_fit(length, lo, count)
    return made.opened, made.plan


def _substitute(made: _Sequences, merged, places: list[int], count: int) -> None:
    """``count`` sequences with these places, largest first: each takes the next actual items of its group.

    The items of a group fall in length, so the filling is constant between the ends of their runs.
    """
    count = min(count, *(sum(r[2] for r in merged[s]) // places.count(s) for s in set(places)))
    first = made.open(count)
    taken = []
    for size in places:  # the runs of each place, in order of the sequences
        got, need = [], count
        while need:
            run = merged[size][0]
            n = min(need, run[2])
            got.append((run[0], run[1], n))
            run[1], run[2], need = run[1] + n, run[2] - n, need - n
            if not run[2]:
                merged[size].pop(0)
        taken.append(got)
    at, where = 0, [[0, 0] for _ in places]
    while at < count:
        n = min(got[i][2] - done for got, (i, done) in zip(taken, where, strict=True))
        room = made.capacity
        for got, place in zip(taken, where, strict=True):
            length, lo, many = got[place[0]]
            made.put(length, lo + place[1], n, first + at, room)
            room -= length
            place[1] += n
            if place[1] == many:
                place[:] = place[0] + 1, 0
        made.hold(room, first + at, n)
        at += n


def pack(pieces: DataFrame, capacity: int = 2048, groups: int = 128, rows_per_lot: int = 50_000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: every piece placed, no sequence beyond ``capacity``.

    Needs a ``length`` from 1 to ``capacity``. Only the histogram, at most ``capacity`` rows, reaches the driver.
    Items of a length are numbered in lots of about ``rows_per_lot``, so a length that a third of all rows
    have is spread over all lots. Repeated rows are packed as often as they occur; an empty table gives no rows.
    """
    spark = pieces.sparkSession
    # the number is drawn once: what is stored is read by both passes
    held = stored(pieces.withColumn("__nf_draw", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    sequences, intervals = plan(counts, capacity, groups)
    lots = max(64, sum(counts.values()) // rows_per_lot)
    lotted = held.withColumn("__nf_lot", F.pmod(F.xxhash64("__nf_draw"), F.lit(lots)))
    before = (
        lotted.groupBy("length", "__nf_lot").agg(F.count("*").alias("n"))
        .selectExpr("length AS __nf_length", "__nf_lot AS __nf_lot_2", "sum(n) OVER (PARTITION BY length ORDER BY __nf_lot) - n AS __nf_before")
    )
    numbered = lotted.selectExpr(
        "*", "row_number() OVER (PARTITION BY length, __nf_lot ORDER BY __nf_draw) - 1 AS __nf_in_lot"
    ).join(before, (F.col("length") == F.col("__nf_length")) & (F.col("__nf_lot") == F.col("__nf_lot_2")))
    item = F.col("__nf_before") + F.col("__nf_in_lot")
    schema = "__nf_l long, __nf_lo long, __nf_hi long, __nf_first long, __nf_offset long"
    placed = numbered.withColumn("__nf_item", item).join(
        F.broadcast(spark.createDataFrame(intervals, schema)),  # bounded by the capacity, not by the rows
        (F.col("length") == F.col("__nf_l")) & (F.col("__nf_item") >= F.col("__nf_lo")) & (F.col("__nf_item") < F.col("__nf_hi")),
    )
    return placed.select(
        *[F.col(f"`{c}`") for c in pieces.columns],
        (F.col("__nf_first") + F.col("__nf_item") - F.col("__nf_lo")).alias("sequence_id"),
        F.col("__nf_offset").alias("offset"),
    )


def assemble(docs: DataFrame, packed: DataFrame, **options) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, at most the capacity's ids in each.

    ``docs`` is tokenized again with the options of :func:`token_pieces`, so that ids are shuffled once, to their
    sequence. Rows of equal id and content are interchangeable: they are matched in any order.
    """
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    order = ", ".join(key)
    # equal pieces are told apart by a running number on both sides; null ids need a value to be joined
    number = f"row_number() OVER (PARTITION BY {order} ORDER BY 1) AS __nf_n"
    pieces = token_pieces(docs, with_ids=True, **options).selectExpr("*", number)
    places = packed.select(*key, "sequence_id", "offset").selectExpr("*", number)
    same = [pieces[k].eqNullSafe(places[k]) for k in [*key, "__nf_n"]]
    found = places.join(pieces, same).select("sequence_id", "offset", "ids")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return found.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
