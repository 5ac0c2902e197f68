"""Exact percentiles of large groups by radix selection.

Spark's ``percentile`` keeps every distinct value of a group in one task. Here a value is a whole number of 64 bits that
sorts as the value does. A pass counts the values by their leading bits, in partial aggregations where the values are; only these
counts are exchanged. The cells that hold a wanted rank are few, and the next pass counts the next bits of their
values alone. Three passes fix a value whatever the distribution; a hot value is one count. Where the wanted
cells hold few values, the next pass takes all the bits left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits below the cells of each pass: 22, 43 and 64 leading bits, so a group has at most 2**22 cells in a pass.
SHIFTS = (42, 21, 0)
#: Cells with at most so many values in a group are resolved at once.
FEW = 1 << 16
#: Groups whose wanted cells are sent to every task in one go, about 100 bytes each.
SENT_GROUPS = 1 << 20

# Fixed values of the 64-bit floating-point format.
MANTISSA, BIAS, LEAST_EXPONENT, INFINITE = 1 << 52, 1023, -1022, 2047


def code(x: Column) -> Column:
    """A long that sorts as the double: its bits, for negative ones those of the absolute value, negated. Both zeros are 0."""
    a = F.abs(x)
    guess = F.greatest(F.floor(F.log2(a)), F.lit(LEAST_EXPONENT))
    low = F.pow(F.lit(2.0), guess)
    # the logarithm of a value next to a power of two may be rounded across it
    exponent = guess + F.when(a >= low * 2, 1).when((a < low) & (guess > LEAST_EXPONENT), -1).otherwise(0)
    share = a / F.pow(F.lit(2.0), exponent) - 1  # exact; below 0 for the values under 2 ** LEAST_EXPONENT
    size = (exponent + BIAS) * F.lit(MANTISSA) + (share * float(MANTISSA)).cast("long")
    size = F.when(a == 0, F.lit(0)).when(a == float("inf"), F.lit(INFINITE * MANTISSA)).otherwise(size)
    return F.when(x < 0, -size).otherwise(size).cast("long")


def decoded(c: Column) -> Column:
    """The double of a code."""
    size = F.abs(c)
    exponent, share = F.shiftright(size, 52), size.bitwiseAND(MANTISSA - 1) / float(MANTISSA)
    power = F.pow(F.lit(2.0), F.greatest(exponent - BIAS, F.lit(LEAST_EXPONENT)))
    value = F.when(exponent == INFINITE, F.lit(float("inf"))).otherwise((share + F.when(exponent > 0, 1).otherwise(0)) * power)
    return F.when(c < 0, -value).otherwise(value)


def _wanted_ranks(probabilities: Sequence[float], total: Column) -> Column:
    """For every probability the two ranks around ``p * (total - 1)``, from 0, as ``i, side, rest``."""
    found = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (total - 1)
        for side, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            found.append(F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), rank.cast("long").alias("rest")))
    return F.array(*found)


def _held(cells: DataFrame, wanted: DataFrame, group: list[str]) -> DataFrame:
    """``wanted`` ranks within the cells that hold them: ``cell, n`` with ``rest``, the rank inside.

    ``cells`` are ``*group, _outer, cell, n``; ``wanted`` are ``*group, _outer, total, i, side, rest`` with the rank inside ``_outer``.
    """
    order = Window.partitionBy(*group, "_outer").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumn("_end", F.sum("n").over(order))
    inside = (F.col("rest") >= F.col("_end") - F.col("n")) & (F.col("rest") < F.col("_end"))
    found = placed.join(wanted, [*group, "_outer"]).filter(inside)
    return found.select(*group, "cell", "n", "total", "i", "side", (F.col("rest") - F.col("_end") + F.col("n")).alias("rest"))


def exact_percentiles(
    values: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    few: int = FEW,
    sent_groups: int = SENT_GROUPS,
) -> DataFrame:
    """``(*group, percentiles ARRAY<DOUBLE>)`` with linear interpolation; nulls and NaN are skipped, groups without others left out.

    Runs a job for every pass; ``values`` are evaluated in each and never exchanged. The wanted cells of all groups are kept in Spark's
    storage, a few rows a group, and sent to all tasks; groups beyond ``sent_groups`` are done in lots of about as many.
    """
    names = {g: f"_g{i}" for i, g in enumerate(group)}
    keys = list(names.values())
    x = F.col(f"`{value}`").cast("double")
    v = values.select(*[F.col(f"`{g}`").alias(n) for g, n in names.items()], x.alias("_v"))
    v = v.filter(F.col("_v").isNotNull() & ~F.isnan("_v")).withColumn("_c", code(F.col("_v"))).drop("_v")
    # nulls are a group too
    v = v.withColumns({k: F.struct(k) for k in keys})

    first = v.groupBy(*keys, F.shiftright("_c", SHIFTS[0]).alias("cell")).agg(F.count("*").alias("n"))
    first = first.withColumn("_outer", F.lit(0).cast("long")).persist()
    totals = first.groupBy(*keys, "_outer").agg(F.sum("n").alias("total"))
    wanted = totals.select("*", F.inline(_wanted_ranks(probabilities, F.col("total"))))
    held = _held(first, wanted, keys).persist()
    groups, most = held.select(*keys).distinct().count(), _most_in_a_group(held, keys)
    lots = -(-groups // sent_groups)
    first.unpersist()

    shift = SHIFTS[0]
    while shift and groups:
        new = 0 if most <= few else SHIFTS[SHIFTS.index(shift) + 1]
        parts = []
        for lot in range(lots):
            own = held if lots == 1 else held.filter(F.pmod(F.xxhash64(*keys), F.lit(lots)) == lot)
            cells = own.groupBy(*keys).agg(F.collect_set("cell").alias("_cells"))
            outer = F.shiftright("_c", shift)
            inside = v.join(F.broadcast(cells), keys).filter(F.array_contains("_cells", outer))
            counts = inside.groupBy(*keys, outer.alias("_outer"), F.shiftright("_c", new).alias("cell")).agg(F.count("*").alias("n"))
            parts.append(_held(counts, own.drop("n").withColumnRenamed("cell", "_outer"), keys).persist())
        for p in parts:
            p.count()
        held = parts[0]
        for p in parts[1:]:
            held = held.unionByName(p)
        most, shift = _most_in_a_group(held, keys), new

    results = []
    for i, p in enumerate(probabilities):
        def pick(side: str, i: int = i) -> Column:
            return F.max(F.when((F.col("i") == i) & (F.col("side") == side), decoded(F.col("cell"))))

        position = F.lit(float(p)) * (F.max("total") - 1)
        low, high, share = pick("low"), pick("high"), position - F.floor(position)
        # no step between ends that are equal or infinite, or to an end that isn't reached
        results.append(F.when((low == high) | (share == 0), low).otherwise(low + (high - low) * share))
    found = held.groupBy(*keys).agg(F.array(*results).alias("percentiles"))
    return found.select(*[F.col(f"{n}.{n}").alias(g) for g, n in names.items()], "percentiles")


def _most_in_a_group(held: DataFrame, keys: list[str]) -> int:
    """The most values that the wanted cells of a group hold."""
    cells = held.select(*keys, "cell", "n").distinct().groupBy(*keys).agg(F.sum("n").alias("n"))
    return cells.agg(F.max("n")).first()[0] or 0


def approximate_percentiles(
    values: DataFrame, group: Sequence[str], value: str, probabilities: Sequence[float], accuracy: int = 10000
) -> DataFrame:
    """One-pass alternative with a bounded sketch per group."""
    x = F.col(value).cast("double")
    clean = values.filter(x.isNotNull() & ~F.isnan(x))
    return clean.groupBy(*group).agg(
        F.percentile_approx(x, list(probabilities), accuracy).alias("percentiles")
    )
