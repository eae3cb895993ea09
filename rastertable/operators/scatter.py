"""Rasters put on another grid, as arrays.

Each source block (a tile or a scene) looks up the target tiles that its cells can reach and works
out its part of them with numpy: values, or sums of weighted values and of weights. A task combines
the parts of a target tile before the shuffle and passes on the rectangle they cover; after it, parts
are combined in one accumulator per target tile. So one shuffle of about the size of the result moves
arrays, no cell is ever a row, and neither a coarse nor a fine target grid makes a group that grows:
parts of a target tile stream, target tiles of a source block are passed on as memory fills.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import replace
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import projection
from ..functions.kernels import SUPPORT, kernel_array, least_weight, negative_lobes
from ..model import CellType, Extent, Layer, Layout
from .fold import HELD_BYTES, NO_RANK, PART_BYTES, Extreme, First, Fold, Mean, in_parts, read_cells, unflatten, write_cells

#: Cells of a target tile that is computed as one; larger ones are computed in blocks.
GRAIN = 1 << 18
_SAMPLES = 9
#: Bytes of finished tiles that go on together.
BATCH_BYTES = 8 << 20


class Kernel(Fold):
    """Sums of weighted values and of weights, the same with bilinear weights where the kernel has
    negative lobes, and whether the target cell's centre lies in a block at all."""

    def __init__(self, method: str):
        self.method = method
        self.types = ("double",) * (5 if negative_lobes(method) else 3)
        self.empty = (0.0,) * len(self.types)

    def merge(self, a, b):
        return tuple(x + y for x, y in zip(a, b))

    def finish(self, state):
        home, wv, w, *bilinear = state
        enough = w > least_weight(self.method)
        value = np.where(enough, wv / np.where(enough, w, 1.0), 0.0)
        if bilinear:  # data cells carry too little of the kernel: what Bilinear fills stays filled
            some = ~enough & (bilinear[1] > least_weight("Bilinear"))
            value = np.where(some, bilinear[0] / np.where(some, bilinear[1], 1.0), value)
            enough |= some
        return value, enough & (home > 0)


def _grid(target: Layout) -> Layout:
    """The target's cells in tiles that can be held: its own, or blocks if these are larger."""
    if target.tile_cells <= GRAIN:
        return target
    w = min(target.cols, 512)
    h = min(target.rows, GRAIN // w)
    across, down = -(-target.cols // w), -(-target.rows // h)
    e, cw, ch = target.extent, target.cell_width, target.cell_height
    return Layout(Extent(e.xmin, e.ymax - down * h * ch, e.xmin + across * w * cw, e.ymax), across, down, w, h)


class _Source:
    """One block: its cells, and where they lie."""

    def __init__(self, facts: tuple, values: np.ndarray, ok: np.ndarray, bands: int):
        self.cols, self.rows, self.ox, self.oy, self.left, self.top, self.cw, self.ch = facts
        size = self.cols * self.rows
        have = min(bands, len(values) // size)
        self.values = values[:have * size].reshape(have, self.rows, self.cols)
        self.ok = ok[:have * size].reshape(have, self.rows, self.cols)

    def reach(self, target: Layout, warp: tuple[int, int], margin: int) -> tuple[int, int, int, int]:
        """First and last target column and row that the block, widened by ``margin`` cells, reaches.

        In another CRS from a grid of samples; borders may bulge between these by no more than
        neighbouring steps differ."""
        if warp[0] == warp[1]:
            ends = []
            for near, far, origin, step, most in (
                    (self.left + (self.ox - margin) * self.cw, self.left + (self.ox + self.cols + margin) * self.cw,
                     target.extent.xmin, target.cell_width, target.cols),
                    (self.top - (self.oy - margin) * self.ch, self.top - (self.oy + self.rows + margin) * self.ch,
                     target.extent.ymax, -target.cell_height, target.rows)):
                ends += [max(0, math.floor((near - origin) / step) - 1), min(most - 1, math.ceil((far - origin) / step) + 1)]
            return tuple(ends)
        x = self.left + np.linspace(self.ox - margin, self.ox + self.cols + margin, _SAMPLES) * self.cw
        y = self.top - np.linspace(self.oy - margin, self.oy + self.rows + margin, _SAMPLES) * self.ch
        x, y = np.meshgrid(x, y)
        with np.errstate(all="ignore"):
            x, y = projection.transform(x, y, *warp, np)
            out = []
            for at, most in (((x - target.extent.xmin) / target.cell_width, target.cols),
                             ((target.extent.ymax - y) / target.cell_height, target.rows)):
                finite = at[np.isfinite(at)]
                if not finite.size:
                    return 0, -1, 0, -1
                steps = np.concatenate([np.abs(np.diff(at, 2, axis=0)).ravel(), np.abs(np.diff(at, 2, axis=1)).ravel()])
                steps = steps[np.isfinite(steps)]
                bulge = steps.max() if steps.size else 0.0
                if finite.size < at.size:  # some samples have no place in the target CRS
                    bulge += (finite.max() - finite.min()) / 2
                out += [max(0, math.floor(finite.min() - bulge) - 1), min(most - 1, math.ceil(finite.max() + bulge) + 1)]
        return tuple(out)

    def place(self, target: Layout, xs: np.ndarray, ys: np.ndarray, warp: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Centres of target cells in cells of this block: one line each where the grids are aligned."""
        x = target.extent.xmin + (xs + 0.5) * target.cell_width
        y = target.extent.ymax - (ys + 0.5) * target.cell_height
        if warp[0] == warp[1]:
            x, y = x[None, :], y[:, None]
        else:
            with np.errstate(all="ignore"):
                x, y = projection.transform(*np.meshgrid(x, y), warp[1], warp[0], np)
        u, v = (x - self.left) / self.cw - self.ox, (self.top - y) / self.ch - self.oy
        # no place in the source CRS: far outside
        return np.where(np.isfinite(u), u, -1e9), np.where(np.isfinite(v), v, -1e9)

    def nearest(self, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i, j = np.floor(u).astype(np.int64), np.floor(v).astype(np.int64)
        inside = (i >= 0) & (i < self.cols) & (j >= 0) & (j < self.rows)
        i, j = np.clip(i, 0, self.cols - 1), np.clip(j, 0, self.rows - 1)
        return self.values[:, j, i], self.ok[:, j, i] & inside

    def weighted(self, u: np.ndarray, v: np.ndarray, method: str) -> tuple:
        """State of ``Kernel``."""
        home = (np.floor(u) >= 0) & (np.floor(u) < self.cols) & (np.floor(v) >= 0) & (np.floor(v) < self.rows)
        data, ok = np.where(self.ok, self.values, 0).astype(float), self.ok.astype(float)
        sums: list[np.ndarray] = []
        for kernel in (method, "Bilinear")[:2 if negative_lobes(method) else 1]:
            a = SUPPORT[method]
            if u.shape[0] == 1 and v.shape[1] == 1:  # aligned grids: a matrix per axis
                across, down = (_matrix(p.ravel(), n, kernel, a) for p, n in ((u, self.cols), (v, self.rows)))
                sums += [down @ x @ across.T for x in (data, ok)]
                continue
            wv = np.zeros((len(data), *home.shape))
            w = np.zeros_like(wv)
            for dy in range(1 - a, a + 1):
                j = np.floor(v - 0.5).astype(np.int64) + dy
                wy = kernel_array(kernel, v - 0.5 - j) * ((j >= 0) & (j < self.rows))
                j = np.clip(j, 0, self.rows - 1)
                for dx in range(1 - a, a + 1):
                    i = np.floor(u - 0.5).astype(np.int64) + dx
                    tap = wy * kernel_array(kernel, u - 0.5 - i) * ((i >= 0) & (i < self.cols))
                    i = np.clip(i, 0, self.cols - 1)
                    wv += tap * data[:, j, i]
                    w += tap * ok[:, j, i]
            sums += [wv, w]
        return (np.broadcast_to(home.astype(float), sums[0].shape), *sums)

    def gathered(self, target: Layout, warp: tuple[int, int], fold: Fold) -> Iterator[tuple]:
        """(block column, block row, first x and y inside, state) where every source cell belongs to the
        target cell its centre falls in."""
        x = self.left + (self.ox + np.arange(self.cols) + 0.5) * self.cw
        y = self.top - (self.oy + np.arange(self.rows) + 0.5) * self.ch
        with np.errstate(all="ignore"):
            x, y = projection.transform(*np.meshgrid(x, y), *warp, np)
            gx, gy = (x - target.extent.xmin) / target.cell_width, (target.extent.ymax - y) / target.cell_height
            inside = (gx >= 0) & (gx < target.cols) & (gy >= 0) & (gy < target.rows)
        gx, gy = (np.floor(np.where(inside, g, 0)).astype(np.int64) for g in (gx, gy))
        w, h = target.tile_cols, target.tile_rows
        block = (gy // h) * target.layout_cols + gx // w
        for which in np.unique(block[inside]):
            mine = inside & (block == which)
            x0, x1, y0, y1 = gx[mine].min(), gx[mine].max() + 1, gy[mine].min(), gy[mine].max() + 1
            shape = (y1 - y0, x1 - x0)
            at = (gy[mine] - y0) * shape[1] + gx[mine] - x0
            order = np.argsort(at, kind="stable")
            at, starts = np.unique(at[order], return_index=True)
            state = tuple(np.full((len(self.values), shape[0] * shape[1]), e, _numpy(t))
                          for e, t in zip(fold.empty, fold.types))
            for b in range(len(self.values)):
                parts = fold.lift(self.values[b][mine][order], self.ok[b][mine][order], 0)
                for into, part in zip(state, _reduced(fold, parts, starts)):
                    into[b, at] = part
            yield (which % target.layout_cols, which // target.layout_cols, x0 % w, y0 % h,
                   tuple(s.reshape(-1, *shape) for s in state))


def _numpy(spark_type: str):
    return np.int64 if spark_type == "bigint" else np.float64


def _reduced(fold: Fold, parts: tuple, starts: np.ndarray) -> tuple:
    """States of runs of equal cells."""
    if isinstance(fold, Extreme):
        low, high = ((np.iinfo(np.int64).min, np.iinfo(np.int64).max) if parts[0].dtype.kind == "i" else (-np.inf, np.inf))
        neutral = high if fold.pick is np.minimum else low
        some = np.add.reduceat(parts[1], starts) > 0
        best = fold.pick.reduceat(np.where(parts[1] > 0, parts[0], neutral), starts)
        return np.where(some, best, 0), some.astype(np.int64)
    return tuple(np.add.reduceat(p, starts) for p in parts)


def _matrix(places: np.ndarray, n: int, kernel: str, a: int) -> np.ndarray:
    """Weight of each of ``n`` source cells for each place along an axis."""
    out = np.zeros((len(places), n))
    base = np.floor(places - 0.5).astype(np.int64)
    line = np.arange(len(places))
    for d in range(1 - a, a + 1):
        i = base + d
        inside = (i >= 0) & (i < n)
        out[line[inside], i[inside]] = kernel_array(kernel, places - 0.5 - i)[inside]
    return out


class _Held:
    """Accumulators of the target tiles a task meets, with the rectangle they cover."""

    def __init__(self, fold: Fold, bands: int, grid: Layout):
        self.fold, self.shape, self.tiles = fold, (bands, grid.tile_rows, grid.tile_cols), {}
        self.bytes = 8 * len(fold.types) * bands * grid.tile_cells

    def add(self, key: tuple, px: int, py: int, state: tuple) -> None:
        if key not in self.tiles:
            empty = tuple(np.full(self.shape, e, _numpy(t)) for e, t in zip(self.fold.empty, self.fold.types))
            self.tiles[key] = [empty, self.shape[2], self.shape[1], 0, 0]
        held = self.tiles[key]
        n, h, w = state[0].shape
        there = (slice(0, n), slice(py, py + h), slice(px, px + w))
        for into, new in zip(held[0], self.fold.merge(tuple(s[there] for s in held[0]), state)):
            into[there] = new
        held[1:] = min(held[1], px), min(held[2], py), max(held[3], px + w), max(held[4], py + h)

    def full(self) -> bool:
        return len(self.tiles) * self.bytes > HELD_BYTES

    def passed_on(self) -> Iterator[tuple[list[tuple], list[tuple], list[list[np.ndarray]]]]:
        """Keys, rectangles (px, py, w, h) and the states inside, one list per part of a state; all
        tiles are let go, part by part."""
        while self.tiles:
            keys = list(islice(self.tiles, max(1, PART_BYTES // self.bytes)))
            tiles = [self.tiles.pop(key) for key in keys]
            boxes = [(x0, y0, x1 - x0, y1 - y0) for _, x0, y0, x1, y1 in tiles]
            yield keys, boxes, [[np.ascontiguousarray(t[0][i][:, y:y + h, x:x + w]).ravel()
                                 for t, (x, y, w, h) in zip(tiles, boxes)] for i in range(len(self.fold.types))]


def _whole_rank(layer: Layer) -> str:
    """The scene id as a whole number: the lowest wins where scenes overlap."""
    kind = layer.df.schema["scene_id"].dataType
    if not isinstance(kind, T.IntegralType):
        raise ValueError(f"scene_id must be a whole number where scenes are put on a grid, not {kind.simpleString()}")
    return "scene_id"


def scattered(layer: Layer, target: Layout, method: str, kind: CellType, warp: tuple[int, int]) -> Layer:
    """A tile or scene layer on the target grid, as tiles (as cells where target tiles are huge).

    Kernel methods and aggregates work on each scene by itself; where scenes overlap the lowest scene_id
    that has data wins, the smaller value of equal ids, whatever the size of scenes or tiles. Tiles of
    equal key: nearest neighbour takes the lowest ``priority``, then the smaller value; for the other methods
    keys must be unique. Tiles without data are no rows.
    """
    scenes, bands, temporal = layer.kind == "scene", layer.meta.bands, layer.meta.temporal
    number = "double" if layer.meta.cell_type.floating else "bigint"
    grid = _grid(target)
    instant = ["instant"] if temporal else []
    if scenes:
        places = {"cols": F.col("cols"), "rows": F.col("rows"), "ox": F.lit(0), "oy": F.lit(0), "left": F.col("xmin"),
                  "top": F.col("ymax"), "cw": (F.col("xmax") - F.col("xmin")) / F.col("cols"),
                  "ch": (F.col("ymax") - F.col("ymin")) / F.col("rows")}
        rank = F.col(_whole_rank(layer)).cast("bigint")
    else:
        at = layer.meta.layout
        places = {"cols": F.lit(at.tile_cols), "rows": F.lit(at.tile_rows),
                  "ox": F.col("col").cast("bigint") * at.tile_cols, "oy": F.col("row").cast("bigint") * at.tile_rows,
                  "left": F.lit(at.extent.xmin), "top": F.lit(at.extent.ymax),
                  "cw": F.lit(at.cell_width), "ch": F.lit(at.cell_height)}
        rank = F.col("priority").cast("bigint") if "priority" in layer.df.columns else F.lit(0).cast("bigint")
    blocks = layer.df.select(*instant, F.coalesce(rank, F.lit(NO_RANK - 1)).alias("rank"),
                             *[c.cast("bigint" if n in ("cols", "rows", "ox", "oy") else "double").alias(n)
                               for n, c in places.items()],
                             F.flatten("bands").cast(f"array<{number}>").alias("flat"))
    pointwise, weighted = method == "NearestNeighbor", method in SUPPORT
    inner: Fold = (First(number) if pointwise else Kernel(method) if weighted else Mean(number) if method == "Average"
                   else Extreme(number, method == "Min"))
    result = number if pointwise or method in ("Max", "Min") else "double"
    fold = First(result) if scenes or pointwise else inner
    margin = SUPPORT[method] if weighted and not scenes else 0
    types, facts = dict(blocks.dtypes), list(places)

    def parts(source: _Source) -> Iterator[tuple]:
        """(column, row, px, py, state of ``inner``) of the target tiles a block reaches."""
        if not (pointwise or weighted):
            yield from source.gathered(grid, warp, inner)
            return
        x0, x1, y0, y1 = source.reach(target, warp, margin)
        w, h = grid.tile_cols, grid.tile_rows
        for row in range(y0 // h, y1 // h + 1):
            ys = np.arange(max(y0, row * h), min(y1 + 1, (row + 1) * h))
            for col in range(x0 // w, x1 // w + 1):
                xs = np.arange(max(x0, col * w), min(x1 + 1, (col + 1) * w))
                u, v = source.place(target, xs, ys, warp)
                west, north = (u >= -margin) & (u <= source.cols + margin), (v >= -margin) & (v <= source.rows + margin)
                if warp[0] == warp[1]:
                    across, down = np.flatnonzero(west[0]), np.flatnonzero(north[:, 0])
                else:
                    near = west & north
                    across, down = np.flatnonzero(near.any(axis=0)), np.flatnonzero(near.any(axis=1))
                if not (len(across) and len(down)):
                    continue
                cut = (slice(down[0], down[-1] + 1), slice(across[0], across[-1] + 1))
                u, v = (p[cut[0] if p.shape[0] > 1 else slice(None), cut[1] if p.shape[1] > 1 else slice(None)] for p in (u, v))
                state = inner.lift(*source.nearest(u, v), 0) if pointwise else source.weighted(u, v, method)
                yield col, row, int(xs[across[0]] - col * w), int(ys[down[0]] - row * h), state

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part, sent = _Held(fold, bands, grid), TaskContext.get().partitionId(), 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            nonlocal sent
            sent += 1
            for keys, boxes, states in held.passed_on():
                columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate(key_types)]
                columns += [pa.array(list(c), pa.int32()) for c in zip(*boxes)]
                columns.append(pa.array([part << 32 | sent] * len(keys), pa.int64()))
                yield pa.RecordBatch.from_arrays([*columns, *map(write_cells, states)], names)

        for batch in in_parts(batches):
            key_types = [pa.int32(), pa.int32(), *[batch.schema.field(k).type for k in instant]]
            found = zip(*[batch.column(c).to_pylist() for c in facts])
            ranks = batch.column("rank").to_pylist()
            # timestamps as numbers: a Python object would lose what is below a microsecond or cost time
            times = zip(*[batch.column(k).to_pylist() for k in instant]) if instant else iter([()] * len(batch))
            values, ok, ends = read_cells(batch.column("flat"))
            for place, r, time, a, b in zip(found, ranks, times, ends, ends[1:]):
                source = _Source(place, values[a:b], ok[a:b], bands)
                if not source.ok.any():
                    continue
                for col, row, px, py, state in parts(source):
                    if fold is not inner:
                        state = fold.lift(*inner.finish(state), r)
                    elif pointwise:
                        state = (state[0], np.where(state[1] == NO_RANK, NO_RANK, r))
                    held.add((int(col), int(row), *time), int(px), int(py), state)
                    if held.full():
                        yield from passed_on()
        yield from passed_on()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, key_types, done = None, _Held(fold, bands, grid), [], []

        def finished() -> None:
            v, ok = fold.finish(held.tiles.pop(last)[0])
            if ok.any():
                done.append((last, v.ravel(), ok.ravel()))

        def passed_on() -> pa.RecordBatch:
            found, v, ok = zip(*done)
            done.clear()
            return pa.RecordBatch.from_arrays(
                [*[pa.array(c, t) for c, t in zip(zip(*found), key_types)], write_cells(v, ok)], [*keys, "flat"])

        for batch in in_parts(batches):
            key_types = [batch.schema.field(k).type for k in keys]
            boxes = [batch.column(c).to_pylist() for c in ("px", "py", "w", "h")]
            states = [read_cells(batch.column(s)) for s in state_names]
            for i, key in enumerate(zip(*[batch.column(k).to_pylist() for k in keys])):
                if key != last and last is not None:
                    finished()
                    if len(done) * bands * grid.tile_cells * 16 > BATCH_BYTES:
                        yield passed_on()
                last = key
                px, py, w, h = (b[i] for b in boxes)
                held.add(key, px, py, tuple(v[e[i]:e[i + 1]].reshape(-1, h, w) for v, _, e in states))
        if last is not None:
            finished()
        if done:
            yield passed_on()

    keys = ["col", "row", *instant]
    state_names = [f"s{i}" for i in range(len(fold.types))]
    names = [*keys, "px", "py", "w", "h", "part", *state_names]
    head = ", ".join(["col int", "row int", *(f"{k} {types[k]}" for k in instant)])
    listed = ", ".join(f"{n} array<{t}>" for n, t in zip(state_names, fold.types))
    sent = blocks.mapInArrow(send, f"{head}, px int, py int, w int, h int, part bigint, {listed}")
    met = sent.repartition(*keys).sortWithinPartitions(*keys, "part")
    done = met.mapInArrow(meet, f"{head}, flat array<{result}>")
    tiles = done.select(*keys, unflatten(grid.tile_cells, bands, kind.compute_type).alias("bands"))
    return layer.with_df(tiles, "tile", layout=grid, cell_type=kind, bounds=None)
