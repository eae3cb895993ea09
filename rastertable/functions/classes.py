"""Class breaks and colour maps as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the class boundary rules.
BOUNDARIES = ("GreaterThan", "GreaterThanOrEqualTo", "LessThan", "LessThanOrEqualTo", "Exact")


def search_tree(leaves: Sequence, split: Callable[[int], Column], leaf: Callable) -> Column:
    """Balanced IF tree over ordered leaves; ``split(i)`` says 'the answer lies before leaf i'."""
    def build(lo: int, hi: int) -> Column:
        if hi - lo == 1:
            return leaf(leaves[lo])
        mid = (lo + hi) // 2
        return F.when(split(mid), build(lo, mid)).otherwise(build(mid, hi))
    return build(0, len(leaves))


def class_of(v: Column, breaks: Mapping, boundary: str, value_type: str) -> Column:
    """Value of the class that ``v`` falls in, NULL when it hits no break.

    LessThan(OrEqualTo): the smallest break above ``v``; GreaterThan(OrEqualTo): the largest break
    below ``v``; Exact: equality. The comparisons number log2 of the breaks and need no join.
    """
    if boundary not in BOUNDARIES:
        raise ValueError(f"unknown boundary {boundary!r}")
    if not breaks:
        return F.lit(None).cast(value_type)
    order = sorted(breaks)
    none = F.lit(None).cast(value_type)
    value = lambda b: F.lit(breaks[b]).cast(value_type)
    if boundary == "Exact":
        return search_tree(order, lambda i: v < F.lit(order[i]),
                           lambda b: F.when(v == F.lit(b), value(b)).otherwise(none))
    if boundary.startswith("Less"):
        strict = boundary == "LessThan"
        upto = lambda b: v < F.lit(b) if strict else v <= F.lit(b)
        return search_tree(order, lambda i: upto(order[i - 1]),
                           lambda b: F.when(upto(b), value(b)).otherwise(none))
    strict = boundary == "GreaterThan"
    above = lambda b: v > F.lit(b) if strict else v >= F.lit(b)
    return search_tree(order, lambda i: ~above(order[i]),
                       lambda b: F.when(above(b), value(b)).otherwise(none))


def ramp_stops(colors: Sequence[int], n: int) -> list[int]:
    """``n`` colours of a ramp: evenly picked, or interpolated per channel when it has fewer."""
    m = len(colors)
    if n == m:
        return list(colors)
    if n == 1 or m == 1:
        return [colors[0]] * n
    out = []
    for i in range(n):
        at = i * (m - 1) / (n - 1)
        if n < m:
            out.append(colors[int(at + 0.5)])
            continue
        k = min(int(at), m - 2)
        mixed = 0
        for shift in (24, 16, 8, 0):
            a, b = (colors[k] >> shift) & 255, (colors[k + 1] >> shift) & 255
            mixed |= int(a + (b - a) * (at - k) + 0.5) << shift
        out.append(mixed)
    return out


@dataclass(frozen=True)
class ColorMap:
    """Break -> 32-bit RGBA colour, with a colour for NoData and one for values past all breaks."""

    breaks: tuple[tuple[float, int], ...]
    no_data_color: int = 0
    fallback_color: int = 0
    boundary: str = "LessThanOrEqualTo"

    @staticmethod
    def from_map(breaks: Mapping, no_data_color: int = 0, fallback_color: int = 0,
                 boundary: str = "LessThanOrEqualTo") -> ColorMap:
        return ColorMap(tuple(sorted(breaks.items())), no_data_color, fallback_color, boundary)

    @staticmethod
    def from_breaks(breaks: Sequence, colors: Sequence[int], no_data_color: int = 0,
                    fallback_color: int = 0, boundary: str = "LessThanOrEqualTo") -> ColorMap:
        order = sorted(set(breaks))
        pairs = tuple(zip(order, ramp_stops(colors, len(order)), strict=True))
        return ColorMap(pairs, no_data_color, fallback_color, boundary)

    def column(self, v: Column) -> Column:
        color = class_of(v, dict(self.breaks), self.boundary, "bigint")
        return (F.when(v.isNull(), F.lit(self.no_data_color).cast("bigint"))
                .otherwise(F.coalesce(color, F.lit(self.fallback_color).cast("bigint"))))
