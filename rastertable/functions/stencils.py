"""Numpy stencils over stacks of padded tiles ``(n, rows + 2r, cols + 2r)``, NaN = NoData."""

from __future__ import annotations

import numpy as np

from .neighborhoods import rectangles

BLOCK_BYTES = 64 * 1024 * 1024


def _view(padded: np.ndarray, dx: int, dy: int, r: int) -> np.ndarray:
    h, w = padded.shape[1] - 2 * r, padded.shape[2] - 2 * r
    return padded[:, r + dy:r + dy + h, r + dx:r + dx + w]


def _fold(padded, offsets, r, start, step):
    acc = start
    for dx, dy in offsets:
        acc = step(acc, _view(padded, dx, dy, r))
    return acc


def _count_sum(padded, offsets, r):
    shape = _view(padded, 0, 0, r).shape
    total, count = np.zeros(shape), np.zeros(shape)
    for dx, dy in offsets:
        v = _view(padded, dx, dy, r)
        data = ~np.isnan(v)
        count += data
        total += np.where(data, v, 0.0)
    return count, total


def _stack(padded, offsets, r):
    return np.stack([_view(padded, dx, dy, r) for dx, dy in offsets])


def _median(stack):
    """Middle value along the first axis; the mean of the middle two for an even count."""
    stack = np.sort(stack, axis=0)
    n = (~np.isnan(stack)).sum(axis=0)
    lo = np.maximum((n - 1) // 2, 0)[None]
    hi = np.maximum(n // 2, 0)[None]
    hi = np.minimum(hi, len(stack) - 1)
    mid = (np.take_along_axis(stack, lo, 0)[0] + np.take_along_axis(stack, hi, 0)[0]) / 2
    return np.where(n > 0, mid, np.nan)


def _mode(stack):
    """Most frequent value along the first axis, the smallest of equals."""
    stack = np.sort(stack, axis=0)
    best = stack[0].copy()
    run = np.where(np.isnan(best), 0, 1)
    best_run = run.copy()
    for k in range(1, len(stack)):
        data = ~np.isnan(stack[k])
        run = np.where(data, np.where(stack[k] == stack[k - 1], run + 1, 1), 0)
        better = run > best_run
        best = np.where(better, stack[k], best)
        best_run = np.where(better, run, best_run)
    return best


class Wide:
    """Neighbourhoods as rectangles: the work follows their number, not that of the cells in them."""

    def __init__(self, offsets, r: int):
        self.boxes, self.r = rectangles(offsets), r

    def worth(self, offsets, operation: str) -> bool:
        """Whether rectangles cost less than offsets; counts that slide pay off in wide ones only."""
        return operation != "Mode" and len(offsets) > (400 if operation == "Median" else 8 * len(self.boxes))

    def sums(self, values):
        """Sum over the neighbourhood, by sums of everything north-west of a cell: four lookups a
        rectangle. What is summed is best near zero, or whole."""
        n, height, width = values.shape
        r, h, w = self.r, height - 2 * self.r, width - 2 * self.r
        before = np.zeros((n, height + 1, width + 1))
        before[:, 1:, 1:] = values.cumsum(axis=1).cumsum(axis=2)
        out = np.zeros((n, h, w))
        for x0, x1, y0, y1 in self.boxes:
            top, bottom, left, right = r + y0, r + y1 + 1, r + x0, r + x1 + 1
            out += (before[:, bottom:bottom + h, right:right + w] - before[:, top:top + h, right:right + w]
                    - before[:, bottom:bottom + h, left:left + w] + before[:, top:top + h, left:left + w])
        return out

    def extreme(self, padded, pick):
        """Least or greatest data value: of spans that double in length, two overlapping ones cover a run."""
        r, h, w = self.r, padded.shape[1] - 2 * self.r, padded.shape[2] - 2 * self.r
        doubled = [padded]  # spans of 1, 2, 4 .. cells to the east
        out = np.full((len(padded), h, w), np.nan)
        for x0, x1, y0, y1 in self.boxes:
            k = (x1 - x0 + 1).bit_length() - 1
            while len(doubled) <= k:
                last, step = doubled[-1], 1 << len(doubled) - 1
                doubled.append(pick(last[:, :, :last.shape[2] - step], last[:, :, step:]))
            rows = pick(doubled[k][:, :, r + x0:r + x0 + w], doubled[k][:, :, r + x1 + 1 - (1 << k):r + x1 + 1 - (1 << k) + w])
            high, span = y1 - y0 + 1, 1
            tall = rows[:, r + y0:r + y1 + h]  # the rows that any cell's rectangle reaches
            while 2 * span <= high:
                tall = pick(tall[:, :tall.shape[1] - span], tall[:, span:])
                span *= 2
            out = pick(out, pick(tall[:, :h], tall[:, high - span:high - span + h]))
        return out

    def median(self, padded):
        """By counts per value that slide along each line: a step takes in one column of cells and lets one
        go. Values are numbered; counts of about as many ranges as a range has values find the middle."""
        out = np.empty((len(padded), padded.shape[1] - 2 * self.r, padded.shape[2] - 2 * self.r))
        for tile, into in zip(padded, out):
            values = np.unique(tile[~np.isnan(tile)])
            if not len(values):
                into[:] = np.nan
                continue
            step = max(1, int(np.sqrt(len(values))))
            size = -(-len(values) // step)
            number = np.where(np.isnan(tile), size * step, np.searchsorted(values, tile))  # the last one: no data
            lines = max(1, min(into.shape[0], BLOCK_BYTES // (4 * (size + 1) * step)))
            for y in range(0, into.shape[0], lines):
                self._slide(number[y:y + lines + 2 * self.r], values, step, size, into[y:y + lines])
        return out

    def _slide(self, number, values, step: int, size: int, into) -> None:
        r, (h, w) = self.r, into.shape
        counts, coarse = np.zeros((h, (size + 1) * step), np.int32), np.zeros((h, size + 1), np.int32)
        line = np.arange(h)

        def take(dx: int, y0: int, y1: int, x: int, sign: int) -> None:
            for dy in range(y0, y1 + 1):
                which = number[r + dy:r + dy + h, r + x + dx]
                counts[line, which] += sign
                coarse[line, which // step] += sign

        for x in range(w):
            for x0, x1, y0, y1 in self.boxes:
                if x == 0:
                    for dx in range(x0, x1 + 1):
                        take(dx, y0, y1, 0, 1)
                else:
                    take(x0, y0, y1, x - 1, -1)
                    take(x1, y0, y1, x, 1)
            total = coarse[:, :size].sum(axis=1)
            up_to = coarse[:, :size].cumsum(axis=1)
            found = []
            for nth in ((total - 1) // 2, total // 2):  # the middle, or the middle two
                part = (up_to <= nth[:, None]).sum(axis=1).clip(max=size - 1)
                rest = nth - np.where(part > 0, up_to[line, part - 1], 0)
                inside = counts.reshape(h, size + 1, step)[line, part].cumsum(axis=1)
                found.append(part * step + (inside <= rest[:, None]).sum(axis=1).clip(max=step - 1))
            low, high = (values[np.minimum(f, len(values) - 1)] for f in found)
            into[:, x] = np.where(total > 0, (low + high) / 2, np.nan)


def _wide_statistic(operation: str, wide: Wide, padded):
    if operation in ("Min", "Max"):
        return wide.extreme(padded, np.fmin if operation == "Min" else np.fmax)
    if operation == "Median":
        return wide.median(padded)
    data = ~np.isnan(padded)
    count = wide.sums(data.astype(float))
    empty = count < 0.5
    count = np.where(empty, np.nan, np.rint(count))
    whole = not np.any(data & (padded != np.rint(padded)))
    # sums of whole numbers are exact; others are taken about the middle of the data
    middle = 0.0 if whole and operation != "StandardDeviation" or not data.any() else np.rint(np.nanmean(padded))
    about = np.where(data, padded - middle, 0.0)
    total = wide.sums(about)
    if operation == "Sum":
        return total + middle * count
    if operation == "Mean":
        return middle + total / count
    variance = wide.sums(about * about) / count - (total / count) ** 2
    return np.sqrt(np.maximum(variance, 0.0))


def focal_statistic(operation: str, offsets, r: int):
    """Stencil of a statistic over the data cells among the offsets; no data cell gives NaN.

    Wide neighbourhoods go by rectangles, so that their cost hardly grows with the radius; Mode and
    ragged ones go by offset.
    """
    wide = Wide(offsets, r)

    def run(padded):
        if wide.worth(offsets, operation):
            return _wide_statistic(operation, wide, padded)
        if operation == "Min":
            return _fold(padded, offsets, r, np.full_like(_view(padded, 0, 0, r), np.nan), np.fmin)
        if operation == "Max":
            return _fold(padded, offsets, r, np.full_like(_view(padded, 0, 0, r), np.nan), np.fmax)
        if operation == "Median":
            return _median(_stack(padded, offsets, r))
        if operation == "Mode":
            return _mode(_stack(padded, offsets, r))
        count, total = _count_sum(padded, offsets, r)
        empty = count == 0
        if operation == "Sum":
            return np.where(empty, np.nan, total)
        mean = total / np.where(empty, np.nan, count)
        if operation == "Mean":
            return mean
        if operation == "StandardDeviation":
            square = np.zeros_like(mean)
            for dx, dy in offsets:
                d = _view(padded, dx, dy, r) - mean
                square += np.where(np.isnan(d), 0.0, d * d)
            return np.sqrt(square / np.where(empty, np.nan, count))
        raise ValueError(f"unknown focal operation {operation!r}")
    return run


def reduce_stack(method: str, stack, fx: int, fy: int):
    """Value of each target cell from its ``fy * fx`` source cells (row by row in the first axis).

    The nearest source cell of a target centre is the one south-east of it; the four cells around
    that centre are equally far away, so linear interpolation is their mean.
    """
    if method == "NearestNeighbor":
        return stack[-1]
    if method == "Median":
        return _median(stack)
    if method == "Mode":
        return _mode(stack)
    if method in ("Max", "Min"):
        return (np.fmax if method == "Max" else np.fmin).reduce(stack, axis=0)
    data = ~np.isnan(stack)
    n = data.sum(axis=0)
    return np.where(data, stack, 0.0).sum(axis=0) / np.where(n == 0, np.nan, n)


def gradient(padded, cell_width: float, cell_height: float, z: float):
    """Rise to the east and to the south per map unit (Horn 1981); missing neighbours count as
    the centre, a missing centre has no gradient."""
    centre = _view(padded, 0, 0, 1)

    gap = np.isnan(centre)

    def at(dx, dy):
        v = _view(padded, dx, dy, 1)
        return np.where(gap | np.isnan(v), centre, v)

    nw, n, ne, w, e, sw, s, se = (at(*d) for d in (
        (-1, -1), (0, -1), (1, -1), (-1, 0), (1, 0), (-1, 1), (0, 1), (1, 1)))
    east = ((ne + 2 * e + se) - (nw + 2 * w + sw)) * z / (8 * cell_width)
    south = ((sw + 2 * s + se) - (nw + 2 * n + ne)) * z / (8 * cell_height)
    return east, south


def slope(cell_width, cell_height, z):
    """Steepest slope in degrees."""
    def run(padded):
        east, south = gradient(padded, cell_width, cell_height, z)
        return np.degrees(np.arctan(np.hypot(east, south)))
    return run


def _aspect(east, south):
    azimuth = np.degrees(np.arctan2(-east, south)) % 360
    azimuth = np.where(azimuth >= 360, 0.0, azimuth)
    return np.where((east == 0) & (south == 0), -1.0, azimuth)


def aspect(cell_width, cell_height):
    """Direction the slope faces, degrees clockwise from north in [0, 360); flat cells are -1."""
    def run(padded):
        east, south = gradient(padded, cell_width, cell_height, 1.0)
        return np.where(np.isnan(east), np.nan, _aspect(east, south))
    return run


def hillshade(cell_width, cell_height, azimuth, altitude, z):
    """Illumination 0..255 by a light at the given azimuth and altitude in degrees."""
    zenith, light = np.radians(90 - altitude), np.radians(azimuth)

    def run(padded):
        east, south = gradient(padded, cell_width, cell_height, z)
        steep = np.arctan(np.hypot(east, south))
        facing = np.arctan2(-east, south)
        lit = (np.cos(zenith) * np.cos(steep)
               + np.sin(zenith) * np.sin(steep) * np.cos(light - facing))
        return np.floor(255 * np.maximum(0.0, lit) + 0.5)
    return run


def blockwise(stencil, padded, r: int, weight: int):
    """Run a stencil over blocks of tiles, or of rows of large tiles, to bound its memory."""
    n, height, width = padded.shape
    h, w = height - 2 * r, width - 2 * r
    per_row = 8 * w * max(weight, 4)
    out = np.empty((n, h, w))
    rows = max(1, min(h, BLOCK_BYTES // per_row))
    tiles = max(1, BLOCK_BYTES // (per_row * rows)) if rows == h else 1
    for i in range(0, n, tiles):
        for y in range(0, h, rows):
            block = padded[i:i + tiles, y:min(y + rows, h) + 2 * r]
            out[i:i + tiles, y:y + rows] = stencil(block)
    return out
