"""Neighbourhoods as lists of (dx east, dy south) offsets in cells."""

from __future__ import annotations

import math
from dataclasses import dataclass

Offsets = list[tuple[int, int]]


def _within(r: float) -> Offsets:
    n = math.floor(r)
    return [(dx, dy) for dy in range(-n, n + 1) for dx in range(-n, n + 1)]


@dataclass(frozen=True)
class Square:
    """max(|dx|, |dy|) <= n."""
    n: float

    def offsets(self) -> Offsets:
        return _within(int(self.n))


@dataclass(frozen=True)
class Nesw:
    """The cross of cells straight north, east, south and west up to n."""
    n: float

    def offsets(self) -> Offsets:
        return [(dx, dy) for dx, dy in _within(int(self.n)) if dx == 0 or dy == 0]


@dataclass(frozen=True)
class Circle:
    """dx^2 + dy^2 <= r^2."""
    radius: float

    def offsets(self) -> Offsets:
        return [(dx, dy) for dx, dy in _within(self.radius)
                if dx * dx + dy * dy <= self.radius ** 2]


@dataclass(frozen=True)
class Annulus:
    """inner^2 <= dx^2 + dy^2 <= outer^2."""
    inner: float
    outer: float

    def offsets(self) -> Offsets:
        return [(dx, dy) for dx, dy in _within(self.outer)
                if self.inner ** 2 <= dx * dx + dy * dy <= self.outer ** 2]


@dataclass(frozen=True)
class Wedge:
    """The part of a circle between two angles, in degrees counter-clockwise from east; an end
    below the start wraps around. The centre belongs to it."""
    radius: float
    start: float
    end: float

    def _between(self, dx: int, dy: int) -> bool:
        angle = math.degrees(math.atan2(-dy, dx)) % 360
        a, b = self.start % 360, self.end % 360
        return a <= angle <= b if a <= b else angle >= a or angle <= b

    def offsets(self) -> Offsets:
        return [(dx, dy) for dx, dy in Circle(self.radius).offsets()
                if (dx, dy) == (0, 0) or self._between(dx, dy)]


def neighborhood(name: str, p1: float = 0, p2: float = 0, p3: float = 0):
    """Neighbourhood by name and parameters."""
    makers = {"Square": lambda: Square(p1), "Nesw": lambda: Nesw(p1), "Circle": lambda: Circle(p1),
              "Annulus": lambda: Annulus(p1, p2), "Wedge": lambda: Wedge(p1, p2, p3)}
    if name not in makers:
        raise ValueError(f"unknown neighbourhood {name!r}")
    return makers[name]()


def reach(offsets: Offsets) -> int:
    return max(max(abs(dx), abs(dy)) for dx, dy in offsets) if offsets else 0


def rectangles(offsets: Offsets) -> list[tuple[int, int, int, int]]:
    """The offsets as disjoint rectangles (first dx, last dx, first dy, last dy): runs of each row, joined
    with equal runs of the rows below."""
    rows: dict[int, list[tuple[int, int]]] = {}
    for dx, dy in sorted(offsets, key=lambda o: (o[1], o[0])):
        runs = rows.setdefault(dy, [])
        if runs and runs[-1][1] == dx - 1:
            runs[-1] = runs[-1][0], dx
        else:
            runs.append((dx, dx))
    out: list[tuple[int, int, int, int]] = []
    growing: dict[tuple[int, int], int] = {}  # run -> its rectangle, where it reaches the row before
    for dy in sorted(rows):
        now = {}
        for run in rows[dy]:
            k = growing.get(run)
            if k is not None and out[k][3] == dy - 1:
                out[k] = (*out[k][:3], dy)
            else:
                k = len(out)
                out.append((*run, dy, dy))
            now[run] = k
        growing = now
    return out
