"""Bit arithmetic on 16-bit detector readings (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mask for bit k of an index selects the positions whose index has bit k set.
INDEX_MASKS = {1: 0xAAAA, 2: 0xCCCC, 4: 0xF0F0, 8: 0xFF00}

PARAMETERS_PER_IMAGE = 9


def unsigned16(reading: Column) -> Column:
    """Pass a reading through, failing on values outside 0..65535."""
    bad = F.concat(F.lit("not an unsigned 16-bit reading: "), reading.cast("string"))
    return F.when(reading.isNull() | reading.between(0, 65535), reading).otherwise(
        F.raise_error(bad)
    )


def unsigned(reading: Column) -> Column:
    """Pass a reading through, failing on negative values."""
    bad = F.concat(F.lit("not an unsigned reading: "), reading.cast("string"))
    return F.when(reading.isNull() | (reading >= 0), reading).otherwise(F.raise_error(bad))


def set_bits(reading: Column) -> Column:
    """Number of set bits."""
    return F.bit_count(reading)


def set_bit_index_sum(reading: Column) -> Column:
    """Sum of the indices of the set bits of a 16-bit reading.

    An index is the sum of its own bits, so the answer is four masked bit counts.
    """
    total = None
    for weight, mask in INDEX_MASKS.items():
        term = F.bit_count(reading.bitwiseAND(F.lit(mask))) * F.lit(weight)
        total = term if total is None else total + term
    return total


def correction_amplitude(
    two_back: Column, three_back: Column, other_three_back: Column, params: Sequence[Column]
) -> Column:
    """Correction of one reading from the readings that preceded it on both amplifiers."""
    if len(params) != PARAMETERS_PER_IMAGE:
        raise ValueError(f"need {PARAMETERS_PER_IMAGE} parameters, got {len(params)}")
    return amplitude_of_parts(transition_parts(two_back, three_back, other_three_back), params)


def transition_parts(two_back: Column, three_back: Column, other_three_back: Column) -> dict[str, Column]:
    """What the amplitude depends on: bits that stayed set, bits newly set, and numbers of set bits."""
    return {
        "both": two_back.bitwiseAND(three_back),
        "only_two": two_back.bitwiseAND(F.bitwise_not(three_back)),
        "own": set_bits(three_back).cast("double"),
        "other": set_bits(other_three_back).cast("double"),
    }


def amplitude_of_parts(parts: Mapping[str, Column] | Column, params: Sequence[Column]) -> Column:
    both, only_two, own, other = (parts[name] for name in ("both", "only_two", "own", "other"))
    features = (
        set_bits(both),
        set_bits(only_two),
        set_bit_index_sum(both),
        set_bit_index_sum(only_two),
        own,
        other,
        own * own,
        other * other,
        own * other,
    )
    total = F.lit(0.0)
    for weight, feature in zip(params, features):
        total = total + weight * feature
    return total
