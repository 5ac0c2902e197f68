"""A Merkle manifest of a dataset: a digest for each row, a tree of them for each group, a tree of the groups.

Rows of a group ascend by id. Their places are found without sorting them: tasks build compressed bitmaps of the ids they
hold, one for every group and chunk of 65,536 ids, the bitmaps are merged, and a row's place is the rows in the
chunks before its own plus its rank in its chunk's bitmap, read from a directory of popcounts. Rows then go into slot
arrays, keyed by place, of 4096 digests each. An array is three levels of the tree, so a group of any size needs an
exchange of digests for every factor of 4096. The way down hands each array the siblings above it.

Ids are whole numbers or null. A null group or id comes before all others. Rows that share group and id follow
each other by their digest; equal rows are leaves of their own. Empty tables have no rows. Texts of any length are
digested where they lie and are not shuffled. Columns that aren't named are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightframe.llm.common import stored

#: Children of a node, and nodes of a slot array: three levels of them.
FANOUT = 16
LEVELS = 3
SLOTS = FANOUT**LEVELS
SLOT_BITS = 12
#: Ids of a bitmap; rows of one that are ranked by one task.
CHUNK_BITS = 16
LOT = 1 << 17
#: Stands for a null id: before every chunk of whole numbers.
NO_CHUNK = -(1 << 62)

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 bytes' count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the encoded values."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def levels_of(size: int) -> int:
    """Levels above the leaves of a tree: none for a lone leaf."""
    n = 0
    while size > 1:
        size, n = -(-size // FANOUT), n + 1
    return n


# ---- places


def _container(lows: np.ndarray) -> bytes:
    """Sorted ids of a chunk, compressed: as they are where few, else a bit for each of the 65,536."""
    if len(lows) < 1 << (CHUNK_BITS - 4):
        return lows.astype("<u2").tobytes()
    bits = np.zeros(1 << CHUNK_BITS, np.uint8)
    bits[lows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _lows(container: bytes) -> np.ndarray:
    if len(container) < 1 << (CHUNK_BITS - 3):
        return np.frombuffer(container, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8), bitorder="little"))


def popcounts(container: bytes) -> bytes:
    """Directory of a bitmap: set bits before each word of 64. Few ids need none."""
    if len(container) < 1 << (CHUNK_BITS - 3):
        return b""
    counts = np.bitwise_count(np.frombuffer(container, "<u8")).astype(np.int64)
    return (np.cumsum(counts) - counts).astype("<u2").tobytes()


def ranks(container: bytes, directory: bytes, lows: np.ndarray) -> np.ndarray:
    """How many ids of the container are below each of ``lows``."""
    if not directory:
        return np.searchsorted(np.frombuffer(container, "<u2"), lows)
    words, before = np.frombuffer(container, "<u8"), np.frombuffer(directory, "<u2")
    at, bit = lows >> 6, (lows & 63).astype(np.uint64)
    below = words[at] & ((np.uint64(1) << bit) - np.uint64(1))
    return before[at].astype(np.int64) + np.bitwise_count(below)


_BITMAP = "page long, tree string, chunk long, container binary, repeated binary, more binary, ids long, members long, total long"
_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_NAMES = ["page", "tree", "chunk", "container", "repeated", "more", "ids", "members", "total", "directory"]


def _bitmap_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=False)], names=_NAMES[: len(columns)])


def _packed(lows: np.ndarray, rows: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """The bitmap, and the ids that have several rows with how many these are beyond one."""
    several = rows > 1
    return _container(lows), lows[several].astype("<u2").tobytes(), (rows[several] - 1).astype("<i8").tobytes()


def _chunks(table: pa.Table, *columns: str) -> Iterator[tuple[str, int, np.ndarray]]:
    """``tree, chunk`` and the numbers of their rows in ``table``, in order of ``columns``."""
    tree = table.column("tree").combine_chunks().dictionary_encode()
    codes, chunk = tree.indices.to_numpy(), table.column("chunk").to_numpy()
    order = np.lexsort((*[table.column(c).to_numpy() for c in reversed(columns)], chunk, codes))
    a, b = codes[order], chunk[order]
    starts = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    for lo, hi in zip(starts, np.append(starts[1:], len(a)), strict=True):
        yield tree.dictionary[int(a[lo])].as_py(), int(b[lo]), order[lo:hi]


def _partial_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bitmap for each tree and chunk of about a million ``page, tree, chunk, low, rows, members`` of different ids."""
    held: list[pa.RecordBatch] = []

    def closed() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        page, low, rows, members = (table.column(n).to_numpy() for n in ("page", "low", "rows", "members"))
        found = [
            (int(page[at[0]]), tree, chunk, *_packed(low[at], rows[at]), len(at), int(members[at].sum()), int(rows[at].sum()))
            for tree, chunk, at in _chunks(table, "low")
        ]
        return _bitmap_rows(found)

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= 1 << 20:
            yield closed()
            held = []
    if any(x.num_rows for x in held):
        yield closed()


def _merged_bitmaps(table: pa.Table) -> pa.Table:
    """Of every tree and chunk of a page one bitmap with its directory, from those of all tasks. No id is in two of them."""
    cell = lambda name, at: table.column(name)[int(at)].as_py()
    found = []
    for tree, chunk, at in _chunks(table):
        lows = np.concatenate([_lows(cell("container", i)) for i in at])
        rows = np.ones(len(lows), np.int64)
        order = np.argsort(lows, kind="stable")
        lows = lows[order]
        for i in at:
            rows[np.searchsorted(lows, np.frombuffer(cell("repeated", i), "<u2"))] += np.frombuffer(cell("more", i), "<i8")
        packed = _packed(lows, rows)
        sums = [sum(cell(n, i) for i in at) for n in ("ids", "members", "total")]
        found.append((cell("page", at[0]), tree, chunk, *packed, *sums, popcounts(packed[0])))
    return pa.Table.from_batches([_bitmap_rows(found)])


def _in_parts(table: DataFrame, *order: str) -> DataFrame:
    """The table stored in ranges of ``order``, each with its number ``part``: what a total before each row needs."""
    ranged = table.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    return stored(ranged, "manifest-parts")


def _totals_before(table: DataFrame, key: str, order: str, value: Column) -> DataFrame:
    """``table`` with ``before``, the total of ``value`` over the rows of ``key`` that come before by ``order``, and ``size``, over all.

    A key of any number of rows is added up part by part: only one total for each part meets in a task.
    """
    parts = _in_parts(table.withColumn("value", value), key, order)
    ends = parts.groupBy(key, "part").agg(F.sum("value").alias("in_part"))
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumns(
        {"earlier": F.coalesce(F.sum("in_part").over(earlier), F.lit(0)), "size": F.sum("in_part").over(Window.partitionBy(key))}
    )
    own = Window.partitionBy(key, "part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    found = parts.withColumn("before", F.coalesce(F.sum("value").over(own), F.lit(0))).join(ends, [key, "part"])
    return found.withColumn("before", F.col("before") + F.col("earlier")).drop("value", "part", "in_part", "earlier")


def _order_of_shared_ids(leaves: DataFrame, ids: DataFrame) -> DataFrame:
    """``leaves`` with ``shift``: rows of the same tree and id whose digests come before.

    The rows of one id may be very many, so they are counted by the first two bytes of their digests, and only those which share these
    are put in order together.
    """
    shared = ids.where("members > 1").select(F.col("tree").alias("t"), F.col("id").alias("i"))
    of_shared = (F.col("tree") == F.col("t")) & F.col("id").eqNullSafe(F.col("i"))
    tied = leaves.join(shared, of_shared, "left_semi").withColumn("head", F.substring("leaf", 1, 2))
    per_head = Window.partitionBy("tree", "id").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        tied.groupBy("tree", "id", "head").agg(F.sum("rows").alias("n"))
        .select(
            F.col("tree").alias("t"), F.col("id").alias("i"), F.col("head").alias("h"),
            F.coalesce(F.sum("n").over(per_head), F.lit(0)).alias("heads_before"),
        )
    )
    own = Window.partitionBy("tree", "id", "head").orderBy("leaf", F.col("claimed").asc_nulls_first())
    own = own.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        tied.withColumn("own_before", F.coalesce(F.sum("rows").over(own), F.lit(0)))
        .join(heads, of_shared & (F.col("head") == F.col("h")))
        .select(
            F.col("tree").alias("pt"), F.col("id").alias("pi"), F.col("leaf").alias("pl"), F.col("claimed").alias("pc"),
            (F.col("heads_before") + F.col("own_before")).alias("shift"),
        )
    )
    same = (F.col("tree") == F.col("pt")) & (F.col("leaf") == F.col("pl"))
    same = same & F.col("id").eqNullSafe(F.col("pi")) & F.col("claimed").eqNullSafe(F.col("pc"))
    return leaves.join(placed, same, "left").select(*leaves.columns, F.coalesce("shift", F.lit(0)).alias("shift"))


_PLACED = "tree string, id long, leaf binary, claimed binary, rows long, place long, size long"


def _ranked(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Rows of a page with their places, from the bitmaps of their chunks."""
    names = ["tree", "id", "leaf", "claimed", "rows"]
    place, size = np.zeros(left.num_rows, np.int64), np.zeros(left.num_rows, np.int64)
    if left.num_rows:
        of_chunk = {(t, c): at[0] for t, c, at in _chunks(right)}
        low, shift = left.column("low").to_numpy(), left.column("shift").to_numpy()
        for tree, chunk, at in _chunks(left):
            cell = lambda name: right.column(name)[int(of_chunk[tree, chunk])].as_py()  # noqa: E731, B023
            lows = low[at]
            found = ranks(cell("container"), cell("directory"), lows)
            repeated = np.frombuffer(cell("repeated"), "<u2")
            if len(repeated):
                more = np.append(0, np.cumsum(np.frombuffer(cell("more"), "<i8")))
                found = found + more[np.searchsorted(repeated, lows)]
            place[at] = cell("before") + found + shift[at]
            size[at] = cell("size")
    return pa.table([*[left.column(n) for n in names], pa.array(place), pa.array(size)], names=[*names, "place", "size"])


def places(leaves: DataFrame) -> DataFrame:
    """``tree, id, leaf, claimed, rows, place, size`` of different ``tree, id, leaf, claimed`` with their number of ``rows``.

    ``place`` is that of the first of the rows among the ``size`` leaves of the tree. Chunks are dealt to pages of about half a chunk's
    ids, so that few tasks' calls serve many chunks where ids lie far apart.
    """
    pages = -(-leaves.count() // (1 << (CHUNK_BITS - 1))) or 1
    chunk = F.coalesce(F.shiftright("id", CHUNK_BITS), F.lit(NO_CHUNK))
    cut = {
        "page": F.pmod(F.xxhash64("tree", chunk), F.lit(pages)),
        "chunk": chunk,
        "low": F.coalesce(F.col("id").bitwiseAND((1 << CHUNK_BITS) - 1), F.lit(0)),
    }
    ids = leaves.groupBy("tree", "id").agg(F.sum("rows").alias("rows"), F.count("*").alias("members"))
    narrow = ids.withColumns(cut).select("page", "tree", "chunk", "low", "rows", "members")
    partial = narrow.mapInArrow(_partial_bitmaps, _BITMAP)
    merged = partial.groupBy("page").applyInArrow(_merged_bitmaps, f"{_BITMAP}, directory binary")
    merged = stored(merged, "manifest-bitmaps")

    before = _totals_before(merged.select("tree", "chunk", "total"), "tree", "chunk", F.col("total")).drop("total")
    # the rows of one id may be very many: its chunk's are then ranked in lots
    lots = F.greatest(F.lit(1), F.ceil(F.col("members") / LOT)).cast("int")
    bitmaps = merged.join(before, ["tree", "chunk"]).select("*", F.explode(F.sequence(F.lit(0), lots - 1)).alias("lot")).select(
        "page", "lot", "tree", "chunk", "container", "directory", "repeated", "more", "before", "size"
    )
    shared, crowded = merged.agg(F.max(F.col("members") > F.col("ids")), F.max(lots) > 1).first()
    leaves = _order_of_shared_ids(leaves, ids) if shared else leaves.withColumn("shift", F.lit(0).cast("long"))
    leaves = leaves.withColumns(cut).withColumn("lot", F.lit(0))
    if crowded:
        many = merged.where(lots > 1).select("tree", "chunk", lots.alias("lots"))
        lot = F.pmod(F.xxhash64("leaf", "claimed"), F.coalesce("lots", F.lit(1))).cast("int")
        leaves = leaves.join(many, ["tree", "chunk"], "left").withColumn("lot", lot)
    rows = leaves.select("page", "lot", "tree", "chunk", "low", "id", "leaf", "claimed", "rows", "shift")
    return rows.groupBy("page", "lot").cogroup(bitmaps.groupBy("page", "lot")).applyInArrow(_ranked, _PLACED)


# ---- slot arrays


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _grow(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and ``levels`` levels above them."""
    found = [nodes]
    for _ in range(levels):
        below = found[-1]
        found.append([_hash("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return found


def _levels_here(size: int, stage: int) -> int:
    return min(max(levels_of(size) - LEVELS * stage, 0), LEVELS)


_ARRAYS = "tree string, block long, size long, nodes binary, ids array<long>, claims array<binary>, node string"


def _fill(stage: int):
    """Slot arrays of a stage from runs ``tree, block, lo, hi, leaf, id, claimed, size`` of equal slots, with the node they grow into."""

    def run(table: pa.Table) -> pa.Table:
        lo, hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
        n = int(hi.max())
        owner = np.zeros(n, np.int64)
        for at, (a, b) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True)):
            owner[a:b] = at
        slots = pa.array(owner)
        leaves = table.column("leaf").combine_chunks().take(slots)
        size = table.column("size")[0].as_py()
        nodes = [x.as_py().hex() for x in leaves]
        top = _grow(nodes, _levels_here(size, stage))[-1]
        whole = bytes.fromhex("".join(nodes))
        ids, claims = (table.column(c).combine_chunks().take(slots) for c in ("id", "claimed"))
        offsets = pa.array([0, n], pa.int32())
        return pa.table(
            [
                table.column("tree").slice(0, 1), table.column("block").slice(0, 1), pa.array([size], pa.int64()),
                pa.array([whole], pa.binary()), pa.ListArray.from_arrays(offsets, ids), pa.ListArray.from_arrays(offsets, claims),
                pa.array([top[0]]),
            ],
            names=["tree", "block", "size", "nodes", "ids", "claims", "node"],
        )

    return run


def _slot_arrays(placed: DataFrame, stage: int) -> DataFrame:
    """Rows with a ``place`` in arrays of ``SLOTS``; equal rows that reach over several are cut."""
    end = F.col("place") + F.col("rows")
    first, last = F.shiftright("place", SLOT_BITS), F.shiftright(end - 1, SLOT_BITS)
    runs = placed.withColumn("block", F.explode(F.sequence(first, last))).select(
        "tree", "block", "leaf", "id", "claimed", "size",
        (F.greatest("place", F.col("block") * SLOTS) - F.col("block") * SLOTS).cast("int").alias("lo"),
        F.least(end - F.col("block") * SLOTS, F.lit(SLOTS)).cast("int").alias("hi"),
    )
    arrays = runs.groupBy("tree", "block").applyInArrow(_fill(stage), _ARRAYS)
    return stored(arrays, f"manifest-arrays-{stage}")


def _stages(placed: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The slot arrays of every stage, and ``tree, node`` with the top of every tree."""
    arrays = [_slot_arrays(placed, 0)]
    tall = F.col("size") > SLOTS
    most = arrays[0].agg(F.max("size")).first()[0] or 0
    tops = [arrays[0].where(~tall).select("tree", "node")]
    reach = SLOTS
    while reach < most:
        above = arrays[-1].where(F.col("size") > reach).select(
            "tree", F.col("block").alias("place"), F.lit(1).cast("long").alias("rows"), F.unhex("node").alias("leaf"),
            F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("claimed"), "size",
        )
        arrays.append(_slot_arrays(above, len(arrays)))
        reach *= SLOTS
        tops.append(arrays[-1].where(F.col("size") <= reach).select("tree", "node"))
    found = tops[0]
    for t in tops[1:]:
        found = found.unionByName(t)
    return arrays, found


# ---- siblings


def _around(level: list[str], at: int) -> tuple[str, str]:
    """The run's other nodes, left and right of node ``at``."""
    start = at - at % FANOUT
    return "".join(level[start:at]), "".join(level[at + 1 : start + FANOUT])


def _siblings(levels: list[list[str]], at: int) -> list[str]:
    """Left and right siblings of leaf ``at``, level by level."""
    found: list[str] = []
    for level in levels[:-1]:
        found += _around(level, at)
        at //= FANOUT
    return found


def _hex_nodes(nodes: bytes) -> list[str]:
    text = nodes.hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def _descend(arrays: DataFrame, above: DataFrame, stage: int) -> DataFrame:
    """``tree, block, above`` for the nodes of a stage's arrays, the blocks of the stage below, from ``above`` of the arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels = _grow(_hex_nodes(row["nodes"]), _levels_here(row["size"], stage))
                n, first = len(levels[0]), row["block"] * SLOTS
                for start in range(0, n, 512):
                    at = range(start, min(start + 512, n))
                    paths = pa.array([_siblings(levels, i) + row["above"] for i in at], pa.list_(pa.string()))
                    blocks = pa.array([first + i for i in at], pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([row["tree"]] * len(at)), blocks, paths], names=["tree", "block", "above"])

    joined = arrays.join(above, ["tree", "block"]).select("tree", "block", "size", "nodes", "above")
    return joined.mapInArrow(run, "tree string, block long, above array<string>")


def _paths(arrays: list[DataFrame], tops: DataFrame | None = None) -> DataFrame:
    """``tree, block, above`` of the lowest arrays: left and right siblings from their tops up to those in ``tops``, which are ``tree, above``.

    Without ``tops`` nothing is above the trees.
    """
    above = None
    for stage in range(len(arrays) - 1, -1, -1):
        reach = SLOTS ** (stage + 1)
        ends = (F.col("size") <= reach) & ((F.col("size") > reach // SLOTS) if stage else F.lit(True))
        here = arrays[stage].where(ends).select("tree").distinct()
        here = here.join(tops, "tree") if tops is not None else here.withColumn("above", F.array().cast("array<string>"))
        here = here.select("tree", F.lit(0).cast("long").alias("block"), "above")
        above = here if above is None else above.unionByName(here)
        if stage:
            above = stored(_descend(arrays[stage], above, stage), f"manifest-paths-{stage}")
    return above


def _proofs(root: str):
    """Rows of the lowest arrays with their proofs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                cell = lambda name: batch.column(name)[at]  # noqa: E731, B023
                levels = _grow(_hex_nodes(cell("nodes").as_py()), _levels_here(cell("size").as_py(), 0))
                above, claims = cell("above").as_py(), cell("claims").as_py()
                leaves = levels[0]
                proofs, folded = [], []
                # what the leaves of a run share is put together once
                shared, rest, known = [], b"", {}
                for i, leaf in enumerate(leaves):
                    if i % FANOUT == 0:
                        shared = (_siblings(levels[1:], i // FANOUT) if len(levels) > 1 else []) + above
                        rest, known = "".join(shared).encode(), {}
                    left, right = _around(leaves, i) if len(levels) > 1 else ("", "")
                    proofs.append(hashlib.sha256((left + right).encode() + rest).hexdigest())
                    start = leaf if claims[i] is None else claims[i].hex()
                    node = _hash(left + start + right) if len(levels) > 1 else start
                    if node not in known:
                        known[node] = _fold(node, shared)
                    folded.append(known[node])
                n = len(leaves)
                same = lambda value: pa.array([value] * n, pa.string())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [
                        cell("ids").values, same(cell("tree").as_py()), pa.array(leaves), same(cell("subroot").as_py()), same(root),
                        pa.array(proofs), pa.array(folded), pa.array([f == root for f in folded]),
                    ],
                    names=["id", "tree", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    return run


def _fold(node: str, siblings: list[str]) -> str:
    """The root that a node and its left and right siblings lead to."""
    for left, right in zip(siblings[::2], siblings[1::2], strict=True):
        node = _hash(left + node + right)
    return node


def manifest(
    docs: DataFrame, id: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS, claimed: Column | None = None
) -> DataFrame:
    """``id, group, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``claimed`` is the leaf of a copy to check against the manifest, null for the row's own. ``folded_root`` is the root that it leads to
    with the row's siblings; ``verified`` says whether that is the root. The columns ``id`` and ``group`` keep their names.
    """
    leaf = leaf_of(*[F.col(f"`{f}`") for f in fields])
    claim = F.unhex(claimed) if claimed is not None else F.lit(None).cast("binary")
    rows = docs.select(
        # a tree's name sorts as its group does, null first
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-")).alias("tree"),
        F.col(f"`{id}`").cast("long").alias("id"),
        F.unhex(leaf).alias("leaf"),
        claim.alias("claimed"),
    )
    leaves = stored(rows.groupBy("tree", "id", "leaf", "claimed").agg(F.count("*").alias("rows")), "manifest-leaves")
    arrays, subroots = _stages(places(leaves))

    subroots = stored(subroots, "manifest-subroots")
    numbered = _totals_before(subroots.withColumn("all", F.lit("all")), "all", "tree", F.lit(1).cast("long"))
    numbered = stored(numbered.select("tree", "node", F.col("before").alias("place"), "size"), "manifest-numbered")
    of_roots = numbered.select(
        F.lit("all").alias("tree"), "place", F.lit(1).cast("long").alias("rows"), F.unhex("node").alias("leaf"),
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("claimed"), "size",
    )
    root_arrays, root_node = _stages(of_roots)
    root = root_node.first()
    under_root = _descend(root_arrays[0], _paths(root_arrays), 0)
    tops = stored(
        numbered.join(under_root.select(F.col("block").alias("place"), "above"), "place").select("tree", "node", "above"),
        "manifest-tops",
    )
    above = _paths(arrays, tops.select("tree", "above")).join(tops.select("tree", F.col("node").alias("subroot")), "tree")
    joined = arrays[0].join(above, ["tree", "block"]).select("tree", "size", "nodes", "ids", "claims", "above", "subroot")
    schema = "id long, tree string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    found = joined.mapInArrow(_proofs(root["node"] if root else ""), schema)
    return found.select(
        F.col("id").cast(docs.schema[id].dataType).alias(id),
        F.when(F.col("tree") != "-", F.substring("tree", 2, 1 << 30)).cast(docs.schema[group].dataType).alias(group),
        "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
    )
