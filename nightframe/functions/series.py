"""Array functions along y for one-row-per-image statistics.

These run on the overscan profile (one short array per image), never on pixels.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shifted(line: Column, back: int) -> Column:
    """The line moved so that element y holds the reading ``back`` steps earlier.

    Negative ``back`` looks ahead. Cells without a reading are null; the length is kept.
    Both halves of the trick stay O(length): a null prefix or suffix and one slice.
    """
    size = F.size(line)
    keep = F.greatest(size - F.lit(abs(back)), F.lit(0))
    pad = F.array_repeat(F.get(line, F.lit(-1)), abs(back))  # a null of the element type
    if back >= 0:
        return F.slice(F.concat(pad, F.slice(line, 1, keep)), 1, size)
    return F.slice(line, abs(back) + 1, keep)


def middle(values: Column) -> Column:
    """Median of an array."""
    ordered = F.array_sort(values)
    n = F.size(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / F.lit(2.0)


def mirrored(values: Column, width: int) -> Column:
    """``width`` mirrored cells on either side (``c b a | a b c``), repeating for short arrays."""
    n = F.size(values)
    back = F.reverse(values)
    # One copy on either side is enough unless the array is shorter than the margin.
    repeats = 2 * ((width + 1) // 2)
    period = F.concat(values, back)
    tiled = F.flatten(F.array_repeat(period, 2 * repeats + 1))
    short = F.slice(tiled, n * (2 * repeats) + 1 - width, n + 2 * width)
    near = F.concat(
        F.reverse(F.slice(values, 1, width)),
        values,
        F.slice(back, 1, width),
    )
    return F.when(n >= width, near).otherwise(short)


def running_median(values: Column, half_width: int) -> Column:
    """Median over ``2*half_width+1`` cells with mirrored edges.

    The window is zipped from shifted slices, so the lambda sees single cells only. (A lambda
    that captured the array could have the array's whole expression inlined and evaluated
    once per element.) Nulls come last in a window; NaN is above all numbers. A line without nulls takes
    the sort by natural order, which calls no comparison lambda.
    """
    n = F.size(values)
    padded = mirrored(values, half_width)
    names = [f"w{k}" for k in range(2 * half_width + 1)]
    window = F.arrays_zip(*[F.slice(padded, k + 1, n).alias(name) for k, name in enumerate(names)])

    def middles(ordered) -> Column:
        return F.transform(window, lambda w: F.get(ordered(F.array(*[w[name] for name in names])), F.lit(half_width)))

    return F.when(F.forall(values, lambda v: v.isNotNull()), middles(F.sort_array)).otherwise(middles(F.array_sort))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def pooled_variance(parts: Column) -> Column:
    """Population variance of the union of groups given as ``struct<n, mean, var>``."""
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def merge(acc: Column, part: Column) -> Column:
        n = acc["n"] + part["n"]
        d = part["mean"] - acc["mean"]
        return F.when(part["n"] == 0, acc).otherwise(
            F.struct(
                n.alias("n"),
                (acc["mean"] + d * part["n"] / n).alias("mean"),
                (acc["m2"] + part["var"] * part["n"] + d * d * acc["n"] * part["n"] / n).alias("m2"),
            )
        )

    return F.aggregate(parts, start, merge, lambda acc: F.when(acc["n"] > 0, acc["m2"] / acc["n"]))
