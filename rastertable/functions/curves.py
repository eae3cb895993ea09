"""Space-filling-curve indices of tile keys as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bit masks that spread an integer so that its bits lie two or three apart.
SPREAD_2 = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
            (2, 0x3333333333333333), (1, 0x5555555555555555))
SPREAD_3 = ((32, 0x001F00000000FFFF), (16, 0x001F0000FF0000FF), (8, 0x100F00F00F00F00F),
            (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249))

# Time unit -> milliseconds.
UNIT_MILLIS = {"millis": 1, "seconds": 1000, "minutes": 60000, "hours": 3600000,
               "days": 86400000, "weeks": 604800000}


def _spread(v: Column, steps) -> Column:
    # one binding per step keeps the expression linear in the number of steps
    state = v.cast("bigint")
    table = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(m).cast("bigint").alias("m"))
                      for s, m in steps])
    return F.aggregate(table, state, lambda acc, step: acc.bitwiseOR(
        F.call_function("shiftleft", acc, step["s"])).bitwiseAND(step["m"]))


def z_index(col: Column, row: Column, slot: Column | None = None) -> Column:
    """Bits interleaved (Morton 1966): 31 bits per axis, 21 with a time slot."""
    left = lambda c, n: F.shiftleft(c, n)
    if slot is None:
        return _spread(col, SPREAD_2).bitwiseOR(left(_spread(row, SPREAD_2), 1))
    return (_spread(col, SPREAD_3).bitwiseOR(left(_spread(row, SPREAD_3), 1))
            .bitwiseOR(left(_spread(slot, SPREAD_3), 2)))


def rowmajor_index(col: Column, row: Column, layout_cols: int) -> Column:
    return row.cast("bigint") * layout_cols + col


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """Position along the Hilbert curve of two or three axes with ``bits`` bits each.

    Skilling's transposition (2004): per bit from the top, and per axis, either flip the lower
    bits of the first axis or swap them with those of the axis; then Gray-decode and interleave.
    """
    n = len(axes)
    big = lambda c: c.cast("bigint")
    names = [f"a{i}" for i in range(n)]
    start = F.struct(*[big(c).alias(k) for c, k in zip(axes, names)])
    steps = F.array(*[F.struct(F.lit(1 << b).cast("bigint").alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])

    def turn(s: Column, step: Column) -> Column:
        q, low = step["q"], step["q"] - 1
        axis = F.get(F.array(*[s[k] for k in names]), step["i"])
        is_set = axis.bitwiseAND(q) != 0
        swap = s["a0"].bitwiseXOR(axis).bitwiseAND(low)
        first = F.when(is_set, s["a0"].bitwiseXOR(low)).otherwise(s["a0"].bitwiseXOR(swap))
        fields = [first.alias("a0")]
        for i, k in enumerate(names[1:], 1):
            fields.append(F.when((step["i"] == i) & ~is_set, s[k].bitwiseXOR(swap))
                          .otherwise(s[k]).alias(k))
        return F.struct(*fields)

    def gray(s: Column) -> Column:
        out = [s["a0"]]
        for k in names[1:]:
            out.append(s[k].bitwiseXOR(out[-1]))
        last = out[-1]
        masks = F.array(*[F.lit(1 << b).cast("bigint") for b in range(bits - 1, 0, -1)])
        t = F.aggregate(masks, F.lit(0).cast("bigint"), lambda acc, q: F.when(
            last.bitwiseAND(q) != 0, acc.bitwiseXOR(q - 1)).otherwise(acc))
        return F.struct(*[c.bitwiseXOR(t).alias(k) for c, k in zip(out, names)])

    turned = F.aggregate(steps, start, turn, gray)
    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i"))
                       for b in range(bits - 1, -1, -1) for i in range(n)])
    # names bound once by a one-element transform
    index = F.transform(F.array(turned), lambda s: F.aggregate(
        places, F.lit(0).cast("bigint"), lambda acc, p: F.shiftleft(acc, 1).bitwiseOR(
            F.call_function("shiftright", F.get(F.array(*[s[k] for k in names]), p["i"]), p["b"])
            .bitwiseAND(F.lit(1).cast("bigint")))))
    return F.get(index, F.lit(0))


def epoch_millis(instant: Column) -> Column:
    """Milliseconds since 1970 of a TIMESTAMP_NTZ, whatever the session time zone."""
    return F.timestamp_diff("MILLISECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")),
                            instant)


def time_slot(instant: Column, unit: str, resolution: int = 1) -> Column:
    """Number of the time block an instant falls in; months and years by calendar."""
    if unit in ("months", "years"):
        months = (F.year(instant) - 1970) * 12 + F.month(instant) - 1
        step = resolution * (12 if unit == "years" else 1)
        return F.floor(months / step).cast("bigint")
    if unit not in UNIT_MILLIS:
        raise ValueError(f"unknown time unit {unit!r}")
    return F.floor(epoch_millis(instant) / (UNIT_MILLIS[unit] * resolution)).cast("bigint")


# --- boxes as runs of an index ---------------------------------------------------------------

def position(curve: str, axes: Sequence[int], bits: int) -> int:
    """``z_index`` or ``hilbert_index`` of one key, on the driver."""
    a = list(axes)
    if curve == "hilbert":
        for b in range(bits - 1, 0, -1):
            low = (1 << b) - 1
            for i in range(len(a)):
                if a[i] >> b & 1:
                    a[0] ^= low
                else:
                    swap = (a[0] ^ a[i]) & low
                    a[0], a[i] = a[0] ^ swap, a[i] ^ swap
        for i in range(1, len(a)):
            a[i] ^= a[i - 1]
        flip = 0
        for b in range(bits - 1, 0, -1):
            if a[-1] >> b & 1:
                flip ^= (1 << b) - 1
        a = [x ^ flip for x in a]
    else:
        a.reverse()  # the first axis has the lowest bit
    out = 0
    for b in range(bits - 1, -1, -1):
        for x in a:
            out = out << 1 | x >> b & 1
    return out


def index_runs(curve: str, box: Sequence[tuple[int, int]], bits: int, most: int = 32) -> list[tuple[int, int]]:
    """Runs of curve positions (first, last) that hold every key of a box, ends included.

    Quadrants (octants) of the curve are runs of it. Those that the box cuts are split, the largest first,
    until ``most`` runs are made; then what is left is taken whole, so runs may hold more than the box.
    """
    n = len(box)
    if any(lo > hi for lo, hi in box):
        return []

    def run(origin: tuple[int, ...], level: int) -> tuple[int, int]:
        first = position(curve, origin, bits) >> (n * level) << (n * level)
        return first, first + (1 << n * level) - 1

    cut, whole = [((0,) * n, bits)], []
    while cut and len(cut) + len(whole) < most:
        origin, level = cut.pop(0)
        half = 1 << level - 1
        for k in range(1 << n):
            part = tuple(o + half * (k >> i & 1) for i, o in enumerate(origin))
            if any(o > hi or o + half - 1 < lo for o, (lo, hi) in zip(part, box)):
                continue
            inside = all(lo <= o and o + half - 1 <= hi for o, (lo, hi) in zip(part, box))
            (whole if inside else cut).append((part, level - 1))
    runs: list[tuple[int, int]] = []
    for first, last in sorted(run(*node) for node in cut + whole):
        if runs and first <= runs[-1][1] + 1:
            runs[-1] = runs[-1][0], max(runs[-1][1], last)
        else:
            runs.append((first, last))
    return runs
