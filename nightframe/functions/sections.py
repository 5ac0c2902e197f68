"""Image sections written as ``[x1:x2,y1:y2]`` (1-based, inclusive)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the textual form of a section.
SECTION_PATTERN = r"^\s*\[(\d+):(\d+),(\d+):(\d+)\]\s*$"

# Names of a parsed section's parts.
FIELDS = ("x_min", "x_max", "x_dir", "y_min", "y_max", "y_dir")


def parse_section(label: Column) -> Column:
    """Struct of 0-based half-open ranges with directions; null for a null label.

    A descending range keeps its cells and gets direction -1. A label that is not a
    section fails the query.
    """

    def of_numbers(n: Column) -> Column:
        x1, x2, y1, y2 = (F.get(n, F.lit(i)) for i in range(4))
        return F.struct(
            (F.least(x1, x2) - 1).alias("x_min"),
            F.greatest(x1, x2).alias("x_max"),
            F.when(x2 < x1, -1).otherwise(1).alias("x_dir"),
            (F.least(y1, y2) - 1).alias("y_min"),
            F.greatest(y1, y2).alias("y_max"),
            F.when(y2 < y1, -1).otherwise(1).alias("y_dir"),
        )

    def of_label(text: Column) -> Column:
        numbers = F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)).cast("array<int>")
        bad = F.raise_error(F.concat(F.lit("not an image section: "), text)).cast(_SECTION_TYPE)
        return F.when(text.rlike(SECTION_PATTERN), _bind(numbers, of_numbers)).when(text.isNotNull(), bad)

    return _bind(label, of_label)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


_SECTION_TYPE = "struct<" + ",".join(f"{f}:int" for f in FIELDS) + ">"


def inside(section: Column, x: Column, y: Column) -> Column:
    return (
        (x >= section["x_min"])
        & (x < section["x_max"])
        & (y >= section["y_min"])
        & (y < section["y_max"])
    )


def section_x(section: Column, x: Column) -> Column:
    """Section-relative x, counted in the section's own direction."""
    return F.when(section["x_dir"] == 1, x - section["x_min"]).otherwise(
        section["x_max"] - 1 - x
    )


def section_y(section: Column, y: Column) -> Column:
    return F.when(section["y_dir"] == 1, y - section["y_min"]).otherwise(
        section["y_max"] - 1 - y
    )


def section_label(nx: Column, ny: Column, x0: Column | int = 0, y0: Column | int = 0) -> Column:
    """Write a section of ``nx`` by ``ny`` cells that starts at 0-based ``(x0, y0)``."""
    x0 = F.lit(x0) if isinstance(x0, int) else x0
    y0 = F.lit(y0) if isinstance(y0, int) else y0
    return F.format_string("[%d:%d,%d:%d]", x0 + 1, x0 + nx, y0 + 1, y0 + ny)
