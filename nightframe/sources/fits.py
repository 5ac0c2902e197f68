"""FITS bytes to rows.

Input is any DataFrame with ``(file_path, content)``, or paths alone where headers are wanted. Two narrow jobs turn a
file into header rows or into detector lines; everything after that is Spark. Uncompressed primary and image
HDUs are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pfs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightframe import schemas
from nightframe.sources.storage import joined, store_of

BLOCK = 2880  # fixed values of the file format: record and card length
CARD = 80
DTYPES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
LINES_PER_BATCH = 256


def _value(text: str):
    """Typed value of a card's text; None if it has none."""
    text = text.strip()
    if text.startswith("'"):
        quoted = re.match(r"'((?:[^']|'')*)'", text)
        return quoted.group(1).replace("''", "'").rstrip() if quoted else None
    text = text.split("/", 1)[0].strip()
    if text in ("T", "F"):
        return text == "T"
    for kind in (int, float):
        try:
            return kind(text.replace("D", "E").replace("d", "e") if kind is float else text)
        except ValueError:
            continue
    return None


#: Reads ``n`` bytes at an offset.
Read = Callable[[int, int], bytes]
#: Records of a header that are read in one go.
RECORDS_PER_READ = 4


def hdus(content: bytes) -> Iterator[tuple[int, dict, int, int]]:
    """``(number, cards, data offset, data bytes)`` of every HDU."""
    return ranged_hdus(lambda at, n: bytes(content[at : at + n]), len(content))


def ranged_hdus(read: Read, length: int, last: int | None = None) -> Iterator[tuple[int, dict, int, int]]:
    """As :func:`hdus` for ``length`` bytes behind ``read``, up to HDU ``last``: headers are read, data are passed over."""
    at, number = 0, 0
    while at + BLOCK <= length and (last is None or number <= last):
        cards: dict = {}
        ended = False
        chunk, used = b"", 0
        while not ended and at + BLOCK <= length:
            if used == len(chunk):
                chunk, used = read(at, min(RECORDS_PER_READ, (length - at) // BLOCK) * BLOCK), 0
            record = chunk[used : used + BLOCK].decode("ascii", "replace")
            at, used = at + BLOCK, used + BLOCK
            for i in range(0, BLOCK, CARD):
                card = record[i : i + CARD]
                key = card[:8].strip()
                if key == "END":
                    ended = True
                    break
                if card[8:10] == "= " and key:
                    value = _value(card[10:])
                    if value is not None:
                        cards.setdefault(key.upper(), value)
        if not ended:
            raise ValueError(f"HDU {number} has no END card")
        axes = [cards[f"NAXIS{i + 1}"] for i in range(cards.get("NAXIS", 0))]
        cells = int(np.prod(axes, dtype=np.int64)) if axes else 0
        size = abs(cards.get("BITPIX", 8)) // 8 * cards.get("GCOUNT", 1) * (cards.get("PCOUNT", 0) + cells)
        if at + size > length:
            raise ValueError(f"HDU {number} is cut off")
        yield number, cards, at, size
        at += -(-size // BLOCK) * BLOCK
        number += 1


def _is_image(cards: dict, size: int) -> bool:
    return size > 0 and cards.get("NAXIS") == 2 and cards.get("XTENSION", "IMAGE") == "IMAGE"


def _unread(cards: dict, size: int) -> str | None:
    """Why the data of an HDU give no lines; None if they do or if there are none."""
    if size == 0 or _is_image(cards, size):
        return None
    if cards.get("ZIMAGE") is True:
        return "compressed image"
    kind = cards.get("XTENSION", "IMAGE")
    return f"image of {cards.get('NAXIS')} dimensions" if kind == "IMAGE" else f"{kind} extension"


def _problem_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for path, content in _files(batches):
        rows, end, number = [], 0, -1
        try:
            for number, cards, at, size in hdus(content):
                end = at + -(-size // BLOCK) * BLOCK
                if reason := _unread(cards, size):
                    rows.append((path, number, reason))
            if end < len(content):
                rows.append((path, number, f"{len(content) - end} bytes after the last HDU"))
        except (ValueError, KeyError) as error:
            rows.append((path, number + 1, str(error)))
        if rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["file_path", "hdu", "reason"])


def file_problems(files: DataFrame) -> DataFrame:
    """``(file_path, hdu, reason)`` for everything that gives no lines: broken files, other data, trailing bytes."""
    return files.select("file_path", "content").mapInArrow(_problem_batches, "file_path STRING, hdu INT, reason STRING")


def _stored(content: bytes, cards: dict, at: int) -> np.ndarray:
    nx, ny = cards["NAXIS1"], cards["NAXIS2"]
    return np.frombuffer(content, DTYPES[cards["BITPIX"]], nx * ny, at).reshape(ny, nx)


def _undefined(content: bytes, cards: dict, at: int) -> np.ndarray | None:
    """The cells of an integer image that hold its BLANK value, laid out as :func:`_pixels`; None if there are none."""
    blank = cards.get("BLANK")
    if cards["BITPIX"] < 0 or type(blank) is not int:
        return None
    found = (_stored(content, cards, at) == blank).T
    return found if found.any() else None


def _pixels(content: bytes, cards: dict, at: int) -> np.ndarray:
    """Physical image with axis 0 = x (the fastest axis of the file) and axis 1 = y."""
    stored = _stored(content, cards, at)
    scale, zero = cards.get("BSCALE", 1), cards.get("BZERO", 0)
    if cards["BITPIX"] > 0 and scale == 1 and float(zero).is_integer():
        return (stored.astype(np.int64) + int(zero)).T
    return (stored.astype(np.float64) * scale + zero).T


def _files(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            yield path.as_py(), memoryview(content.as_buffer())


def _readable(path: str, content: bytes, strict: bool) -> list[tuple[int, dict, int, int]]:
    """All HDUs of a file; of a broken file none, or an error when strict."""
    try:
        return list(hdus(content))
    except (ValueError, KeyError) as error:
        if strict:
            raise ValueError(f"{path}: {error}") from error
        return []


_HEADER_KINDS = [
    pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.bool_(), pa.bool_()
]


def _header_batch(path: str, parts: Iterable[tuple[int, dict, int, int]], keys: frozenset[str] | None = None) -> pa.RecordBatch:
    """The cards of a file's HDUs as rows, those of ``keys`` if given."""
    names = schemas.HEADER_ROWS.names
    columns: list[list] = [[] for _ in names]
    image = 0
    for number, cards, _, size in parts:
        with_data, is_image = size > 0, _is_image(cards, size)
        for key, value in sorted(cards.items()):
            if keys is not None and key not in keys:
                continue
            kind = type(value).__name__
            row = (
                path, number, image if is_image else None, key, kind,
                value if kind == "str" else None,
                float(value) if kind in ("int", "float") else None,
                value if kind == "bool" else None,
                with_data,
            )
            for column, cell in zip(columns, row):
                column.append(cell)
        image += is_image
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _HEADER_KINDS)], names=names)


def _header_batches(batches: Iterable[pa.RecordBatch], strict: bool = True) -> Iterator[pa.RecordBatch]:
    for path, content in _files(batches):
        yield _header_batch(path, _readable(path, content, strict))


def header_rows(files: DataFrame, strict: bool = True) -> DataFrame:
    """All header cards of all HDUs as rows; cards without value are left out.

    A broken file is an error; unless ``strict`` it has no rows and :func:`file_problems` names it.
    """
    run = partial(_header_batches, strict=strict)
    return files.select("file_path", "content").mapInArrow(run, schemas.HEADER_ROWS)


def stored_header(
    store: pfs.FileSystem, path: str, name: str, length: int | None, strict: bool = True, last: int | None = None,
    keys: frozenset[str] | None = None,
) -> pa.RecordBatch:
    """Header rows of a file in a store, of which only the headers are read; ``name`` is its ``file_path``."""
    with store.open_input_file(path) as f:
        size = f.size() if length is None else length
        try:
            parts = list(ranged_hdus(lambda at, n: f.read_at(n, at), size, last))
        except (ValueError, KeyError) as error:
            if strict:
                raise ValueError(f"{name}: {error}") from error
            parts = []
    return _header_batch(name, parts, keys)


def header_rows_at(files: DataFrame, root: str, strict: bool = True, last: int | None = None) -> DataFrame:
    """:func:`header_rows` of the files ``(file_path, length)`` below ``root``, up to HDU ``last``.

    The tasks open the files themselves and read the records of headers alone, whatever lies between. Files are dealt
    evenly to twice as many tasks as there are cores.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root)
        for batch in batches:
            for name, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield stored_header(store, joined(base, name), name, length, strict, last)

    tasks = 2 * files.sparkSession.sparkContext.defaultParallelism
    return files.select("file_path", "length").repartition(tasks).mapInArrow(run, schemas.HEADER_ROWS)


def headers_of(header: DataFrame, hdu: int = 0) -> DataFrame:
    """Cards of one HDU; a file that does not have it is an error."""
    shape = header.groupBy("file_path").agg(F.max("hdu").alias("_last"))
    message = F.concat(F.lit("no such HDU in "), F.col("file_path"))
    checked = shape.select(
        F.when(F.col("_last") >= hdu, F.col("file_path")).otherwise(F.raise_error(message)).alias("file_path")
    )
    return checked.join(header.filter(F.col("hdu") == hdu), "file_path")


def headers_of_data(header: DataFrame) -> DataFrame:
    """Cards of every HDU that holds data."""
    return header.filter("has_data")


_SECTIONS = pa.list_(
    pa.struct([("amp", pa.int32()), ("datasec", pa.string()), ("biassec", pa.string())])
)
_LINE_FIELDS = [
    ("exposure_id", pa.string()), ("hdu", pa.int32()), ("amp", pa.int32()), ("x", pa.int32()),
    ("data", None), ("channel", pa.string()), ("obstype", pa.string()), ("datasec", pa.string()),
    ("biassec", pa.string()), ("saturate", pa.float64()), ("x_extent", pa.int32()),
    ("bias_lo", pa.int32()), ("bias_hi", pa.int32()), ("image_sections", _SECTIONS),
]
_LINE_DDL = (
    "exposure_id STRING, hdu INT, amp INT, x INT, data ARRAY<{kind}>, channel STRING, obstype STRING, "
    "datasec STRING, biassec STRING, saturate DOUBLE, x_extent INT, bias_lo INT, bias_hi INT, "
    "image_sections ARRAY<STRUCT<amp: INT, datasec: STRING, biassec: STRING>>"
)


def _bias_span(images: list[dict]) -> tuple[int | None, int | None]:
    ends = []
    for cards in images:
        found = re.match(r"\s*\[(\d+):(\d+),", str(cards.get("BIASSEC", "")))
        if found:
            ends += [int(found.group(1)), int(found.group(2))]
    return (min(ends) - 1, max(ends)) if ends else (None, None)


def _line_batches(integer: bool, with_header: bool, strict: bool):
    fields = [*_LINE_FIELDS, ("header", pa.string())] if with_header else _LINE_FIELDS
    kind, dtype = (pa.int32(), np.int32) if integer else (pa.float64(), np.float64)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [n for n, _ in fields]
        for path, content in _files(batches):
            parts = _readable(path, content, strict)
            lost = [r for _, cards, _, size in parts if (r := _unread(cards, size)) and "image" in r]
            if strict and lost:
                raise ValueError(f"{path} holds a {lost[0]}, which is not read")
            primary = parts[0][1] if parts else {}
            images = [p for p in parts if _is_image(p[1], p[3])]
            low, high = _bias_span([cards for _, cards, _, _ in images])
            for amp, (number, cards, at, _) in enumerate(images):
                pixels, undefined = _pixels(content, cards, at), _undefined(content, cards, at)
                if integer and pixels.dtype.kind == "f":
                    raise ValueError(f"{path}: HDU {number} does not hold integers")
                split = None
                if len(images) == 1 and "DATASEC0" in cards:
                    if cards.get("CCDNAMP", 2) != 2:
                        raise ValueError(f"{path}: expected 2 amplifiers")
                    split = [
                        {"amp": i, "datasec": cards[f"DATASEC{i}"], "biassec": cards[f"BIASSEC{i}"]}
                        for i in (0, 1)
                    ]
                level = cards.get("SATURATE")
                constant = {
                    "exposure_id": path, "hdu": number, "amp": amp,
                    "channel": cards.get("CHANNEL", primary.get("CHANNEL")),
                    "obstype": cards.get("OBSTYPE", primary.get("OBSTYPE")),
                    "datasec": cards.get("DATASEC"), "biassec": cards.get("BIASSEC"),
                    "saturate": None if level is None else float(level),
                    "x_extent": pixels.shape[0], "bias_lo": low, "bias_hi": high,
                    "image_sections": split,
                    "header": json.dumps(dict(sorted(cards.items()))) if with_header else None,
                }
                for start in range(0, pixels.shape[0], LINES_PER_BATCH):
                    block = np.ascontiguousarray(pixels[start : start + LINES_PER_BATCH], dtype)
                    x, lacking = np.arange(start, start + len(block), dtype=np.int32), None
                    if undefined is not None:
                        lacking = undefined[start : start + LINES_PER_BATCH]
                        held = ~lacking.all(axis=1)
                        block, x, lacking = block[held], x[held], lacking[held].reshape(-1)
                    n, length = block.shape
                    offsets = np.arange(n + 1, dtype=np.int32) * length
                    moving = {
                        "x": pa.array(x),
                        "data": pa.ListArray.from_arrays(pa.array(offsets), pa.array(block.reshape(-1), kind, mask=lacking)),
                    }
                    yield pa.RecordBatch.from_arrays(
                        [moving[f] if f in moving else pa.array([constant[f]] * n, t) for f, t in fields],
                        names=names,
                    )

    return decode


def image_lines(files: DataFrame, integer: bool = False, strict: bool = True) -> DataFrame:
    """All image HDUs as lines, one row per ``(exposure_id, hdu, x)`` with ``data`` along y.

    ``exposure_id`` is the file path and ``amp`` counts the images of the file. ``integer``
    keeps detector readings as 32-bit integers, as the bit-level corrections need them. Cells of an integer image
    that hold its BLANK value are null, and a line of such cells alone has no row. A broken file or an image
    in another form is an error; unless ``strict`` it gives no lines and :func:`file_problems` names it.
    """
    return _decode(files, integer, with_header=False, strict=strict)


def _decode(files: DataFrame, integer: bool, with_header: bool, strict: bool = True) -> DataFrame:
    schema = _LINE_DDL.format(kind="INT" if integer else "DOUBLE")
    if with_header:
        schema += ", header STRING"
    return files.select("file_path", "content").mapInArrow(_line_batches(integer, with_header, strict), schema)


def lines_of(lines: DataFrame, hdu: int) -> DataFrame:
    """Lines of one HDU."""
    return lines.filter(F.col("hdu") == hdu)


def with_zero_variance(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("variance", F.lit(0.0))


def images_with_headers(files: DataFrame, integer: bool = False) -> DataFrame:
    """Lines with all cards of their image as a map ``header``, and zero variance.

    The decoder holds the cards anyway, so they travel with the lines as text and no join of
    lines with header rows is needed.
    """
    lines = _decode(files, integer, with_header=True)
    cards = F.from_json("header", "map<string,string>")
    variance = F.transform("data", lambda _: F.lit(0.0))
    return lines.withColumns({"header": cards, "variance": variance})
