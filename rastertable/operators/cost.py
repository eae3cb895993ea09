"""Accumulated cost from source cells over a friction layer (Tomlin 1990).

The map is cut into regions of about the same number of cells, whatever the tile size. A region solves
itself: from its sources and from the costs along its neighbours' borders it works out the least costs
of all its cells. What the rounds pass on and remember are borders only, one strip per side and region:
a round reads the regions whose strips changed, and writes the strips these send on. When no strip
changes any more, all regions that were reached are filled once. The number of rounds follows from how
many region borders the least paths cross. Every round is a table in the shared folder that holds the
whole state, so nothing grows with the number of rounds and a lost executor costs one round at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import CellType, Extent, Layer, Layout
from ..plans.joins import BROADCAST_BYTES
from ..plans.lineage import run_folder, through_table
from .distance import cell_centres
from .focal import nullable_lists, padded_windows
from .geometry import envelope, near
from .shape import to_tiles

#: Cells along a side of a region, at least one tile.
REGION = 256
#: Tables of news of one age that are put together.
AGED = 8
#: Regions that a task solves side by side.
TOGETHER = 4
# the sides a strip can come from, as seen by its receiver
SIDES = [(dx, dy) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dx or dy]


def solve(friction: np.ndarray, cost: np.ndarray, cw: float, ch: float, limit: float) -> np.ndarray:
    """Least costs inside padded regions ``(n, h + 2, w + 2)``; NaN friction blocks, inf is unreached.

    A move costs its length times the mean friction of its two cells. The outer ring only gives. Cells
    whose cost fell offer it to their neighbours, all at once, until none falls any more; so the work
    follows the cells that are reached.
    """
    shape = friction.shape
    inner = np.zeros(shape, bool)
    inner[:, 1:-1, 1:-1] = ~np.isnan(friction[:, 1:-1, 1:-1])
    f, inner = friction.ravel(), inner.ravel()
    d = np.where(np.isnan(f), np.inf, cost.ravel())
    moves = [(dy * shape[2] + dx, math.hypot(dx * cw, dy * ch) / 2) for dx, dy in SIDES]
    front = np.flatnonzero(np.isfinite(d))
    # a neighbour of the ring may lie in the region before or behind, but is never taken for an inner cell's
    ring = front[~inner[front]]
    while len(front):
        to, offers = [], []
        for step, half in moves:
            there = front + step
            here = front
            if len(ring):  # the ring's cells see the inner cells of their own region only
                ok = (there >= 0) & (there < len(d))
                there, here = there[ok], here[ok]
                own = _adjacent(here, there, shape)
                there, here = there[own], here[own]
            open_ = inner[there]
            there, here = there[open_], here[open_]
            offer = d[here] + half * (f[here] + f[there])
            less = (offer < d[there]) & (offer <= limit)
            to.append(there[less])
            offers.append(offer[less])
        to, offers = np.concatenate(to), np.concatenate(offers)
        np.minimum.at(d, to, offers)
        front, ring = np.unique(to), ring[:0]
    return d.reshape(shape)[:, 1:-1, 1:-1]


def _adjacent(a: np.ndarray, b: np.ndarray, shape: tuple) -> np.ndarray:
    """Whether two places of a stack of regions touch: steps of the ring must not wrap around."""
    n, w = shape[1] * shape[2], shape[2]
    return (a // n == b // n) & (np.abs(a % w - b % w) <= 1)


class _Regions:
    """Regions of whole tiles over a layout."""

    def __init__(self, layout: Layout):
        self.kx = min(max(1, REGION // layout.tile_cols), layout.layout_cols)
        self.ky = min(max(1, REGION // layout.tile_rows), layout.layout_rows)
        self.tc, self.tr = layout.tile_cols, layout.tile_rows
        # on a map narrower than a region, rounds follow its length: as many cells, but longer
        if self.kx * self.tc < REGION and self.kx == layout.layout_cols:
            self.ky = min(max(self.ky, REGION * REGION // (self.kx * self.tc * self.tr)), layout.layout_rows)
        elif self.ky * self.tr < REGION and self.ky == layout.layout_rows:
            self.kx = min(max(self.kx, REGION * REGION // (self.ky * self.tr * self.tc)), layout.layout_cols)
        self.w, self.h = self.kx * self.tc, self.ky * self.tr
        self.across, self.down = -(-layout.layout_cols // self.kx), -(-layout.layout_rows // self.ky)

    def of_tile(self) -> list[Column]:
        return [F.expr(f"col div {self.kx}").cast("int").alias("rc"), F.expr(f"row div {self.ky}").cast("int").alias("rr")]

    def ring(self, dx: int, dy: int) -> tuple[slice, slice]:
        """Where a padded region holds the strip of a side."""
        pick = lambda d, n: slice(0, 1) if d < 0 else slice(n + 1, n + 2) if d > 0 else slice(1, n + 1)
        return pick(dy, self.h), pick(dx, self.w)

    def edge(self, dx: int, dy: int) -> tuple[slice, slice]:
        """The cells of a region that its neighbour on a side sees."""
        pick = lambda d, n: slice(0, 1) if d < 0 else slice(n - 1, n) if d > 0 else slice(0, n)
        return pick(dy, self.h), pick(dx, self.w)


def _reachable(tiles: DataFrame, layout: Layout, band: int, area: Extent | None,
               limit: float) -> DataFrame:
    """Tiles that can be reached at all: costs grow by at least the smallest friction per map
    unit, which bounds how far ``limit`` reaches from the sources."""
    if area is None or math.isinf(limit):
        return tiles if area is not None else tiles.where("false")
    least = F.array_min(F.filter(F.get("bands", F.lit(band)), lambda v: v.isNotNull()))
    lowest = tiles.agg(F.min(least)).first()[0]
    if lowest is None or lowest <= 0:
        return tiles
    step = min(layout.cell_width, layout.cell_height)
    return near(tiles, layout, area, math.ceil(limit / lowest / step) + 1)


def _solved(at: _Regions, layout: Layout, limit: float, batch: pa.RecordBatch) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """Rows of a batch, their padded friction and the least costs inside."""
    cells, cw, ch = at.w * at.h, layout.cell_width, layout.cell_height
    starts, strips = batch.column("starts"), batch.column("strips")
    for first in range(0, len(batch), TOGETHER):
        rows = range(first, min(len(batch), first + TOGETHER))
        own = batch.column("f").slice(first, TOGETHER).flatten().to_numpy(zero_copy_only=False).reshape(-1, at.h, at.w)
        f = np.full((len(rows), at.h + 2, at.w + 2), np.nan)
        d = np.full(f.shape, np.inf)
        for k, row in enumerate(rows):
            f[k, 1:-1, 1:-1] = own[k]
            inner = np.full(cells, np.inf)
            inner[starts[row].as_py() or []] = 0.0
            d[k, 1:-1, 1:-1] = inner.reshape(at.h, at.w)
            for strip in strips[row].values or [] if strips[row].is_valid else []:
                there = (k, *at.ring(*SIDES[strip["side"].as_py()]))
                shape = d[there].shape
                d[there] = strip["d"].values.to_numpy().reshape(shape)
                f[there] = strip["f"].values.to_numpy().reshape(shape)
        yield rows, f, solve(f, d, cw, ch, limit)


def cost_distance(layer: Layer, sources: DataFrame | None = None, max_distance: float = math.inf,
                  band: int = 0, polygons: DataFrame | None = None, lines: DataFrame | None = None) -> Layer:
    """Least accumulated friction from the cells that hold ``sources`` (x, y in map coordinates), or from
    the cells that ``polygons`` hold or ``lines`` cross.

    Eight moves, diagonal length by cell size; NoData blocks; beyond ``max_distance`` is NoData. Without a
    source that lies on data the result is empty. A layer in time is solved for each instant. A task holds
    regions of about 256 x 256 cells, or of one tile where tiles are larger.
    """
    if (sources is None) == (polygons is None and lines is None):
        raise ValueError("give points, or polygons and lines")
    tiles = to_tiles(layer)
    spark = layer.base.sparkSession
    layout = layer.meta.layout
    others = ["instant"] if layer.meta.temporal else []
    keys, limit, at = ["rc", "rr", *others], float(max_distance), _Regions(layout)
    folder = run_folder(spark, "cost")
    points = sources if sources is not None else cell_centres(layout, polygons, lines)
    x, y = layout.cell_of(F.col("x"), F.col("y"))
    starts = points.select(x.alias("cx"), y.alias("cy")).where(
        F.col("cx").between(0, layout.cols - 1) & F.col("cy").between(0, layout.rows - 1)).distinct()
    place = (F.col("cy") % at.h) * at.w + F.col("cx") % at.w
    starts = through_table(starts.groupBy(F.expr(f"cx div {at.w}").cast("int").alias("rc"),
                                          F.expr(f"cy div {at.h}").cast("int").alias("rr"))
                           .agg(F.collect_list(place.cast("int")).alias("starts")), f"{folder}/starts")
    given = points if sources is not None else polygons if lines is None else lines if polygons is None else None
    area = envelope(given)[0] if given is not None else envelope(polygons)[0].combine(envelope(lines)[0])
    friction = _friction(_reachable(tiles.df, layout, band, area, limit), at, band, keys, others, f"{folder}/friction")
    lowest = friction.agg(F.min(F.array_min("f"))).first()[0]
    if lowest is not None and lowest < 0:
        raise ValueError("friction must not be negative")
    types = dict(friction.dtypes)
    head = ", ".join(f"{k} {types[k]}" for k in keys)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The strips that solved regions show their neighbours."""
        for batch in batches:
            for rows, f, d in _solved(at, layout, limit, batch):
                out: list[tuple] = []
                for k, row in enumerate(rows):
                    rc, rr, *rest = (batch.column(c)[row].as_py() for c in keys)
                    for side, (dx, dy) in enumerate(SIDES):  # the receiver lies opposite of the side it sees us on
                        cut = at.edge(-dx, -dy)
                        to = rc - dx, rr - dy
                        if 0 <= to[0] < at.across and 0 <= to[1] < at.down and np.isfinite(d[k][cut]).any():
                            out.append((*to, *rest, side, d[k][cut].ravel(), f[k, 1:-1, 1:-1][cut].ravel()))
                if out:
                    columns = list(zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                         *[pa.array(c, batch.schema.field(k).type) for c, k in zip(columns[2:], others)],
                         pa.array(columns[-3], pa.int32()), pa.array(columns[-2], pa.list_(pa.float64())),
                         pa.array(columns[-1], pa.list_(pa.float64()))], [*keys, "side", "d", "f"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The tiles of solved regions that any cost reaches."""
        for batch in batches:
            for rows, _, d in _solved(at, layout, limit, batch):
                found, cells = [], []
                for k, row in enumerate(rows):
                    rc, rr, *rest = (batch.column(c)[row].as_py() for c in keys)
                    parts = d[k].reshape(at.ky, at.tr, at.kx, at.tc).swapaxes(1, 2)
                    for j, i in zip(*np.nonzero(np.isfinite(parts).any(axis=(2, 3)))):
                        found.append((rc * at.kx + int(i), rr * at.ky + int(j), *rest))
                        cells.append(parts[j, i].ravel())
                if found:
                    values = np.stack(cells)
                    columns = list(zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                         *[pa.array(c, batch.schema.field(k).type) for c, k in zip(columns[2:], others)],
                         nullable_lists(np.where(np.isfinite(values), values, np.nan))], ["col", "row", *others, "d"])

    none = F.lit(None).cast("array<struct<side:int,d:array<double>,f:array<double>>>")
    columns = [*keys, "f", "starts", "strips"]
    start_bytes = starts.agg(F.coalesce(F.sum(64 + 4 * F.size("starts")), F.lit(0))).first()[0]
    strip_bytes = F.coalesce(F.sum(64 + 16 * F.size("d").cast("bigint")), F.lit(0))

    def met(side: DataFrame, on: list[str], most: int, how: str = "inner") -> DataFrame:
        """Friction with ``side``, which is broadcast where it is small."""
        return friction.join(F.broadcast(side) if most <= BROADCAST_BYTES else side.hint("merge"), on, how)

    def latest(strips: DataFrame) -> DataFrame:
        return strips.groupBy(*keys, "side").agg(F.max_by(F.struct("d", "f"), "nth").alias("s")).select(*keys, "side", "s.*")

    def ringed(strips: DataFrame) -> DataFrame:
        """The strips of each region, eight at most."""
        return strips.groupBy(*keys).agg(F.collect_list(F.struct("side", "d", "f")).alias("strips"))

    work = met(starts, ["rc", "rr"], start_bytes).withColumn("strips", none)
    strip_schema = f"{head}, side int, d array<double>, f array<double>, nth int"
    written: list[tuple[int, str]] = []  # ages and paths of the tables of news
    strips, around, nth, total = None, None, 0, 0

    def of_regions(found: DataFrame, few: int) -> DataFrame:
        """The latest strips of ``found``'s regions, their keys broadcast where there are ``few``."""
        small = few * 64 <= BROADCAST_BYTES
        return latest(strips.join(F.broadcast(found) if small else found.hint("merge"), keys, "left_semi"))

    while True:
        sent = work.select(*columns).mapInArrow(send, f"{head}, side int, d array<double>, f array<double>")
        if strips is not None:  # what a region sends that its neighbour has had in no round before is news
            known = of_regions(around, 9 * changed).withColumnsRenamed({"d": "old_d", "f": "old_f"})
            sent = sent.join(known, [*keys, "side"], "left").where(~F.col("d").eqNullSafe(F.col("old_d"))).drop("old_d", "old_f")
        path = f"{folder}/round={nth}"
        news = through_table(sent.withColumn("nth", F.lit(nth)), path)
        changed, size = news.agg(F.count("*"), strip_bytes).first()
        if not changed:
            break
        total += size
        written.append((0, path))
        while len(written) >= AGED and written[-AGED][0] == written[-1][0]:
            age, paths = written[-1][0] + 1, [p for _, p in written[-AGED:]]
            path = f"{folder}/age={age}-{nth}"
            aged = spark.read.schema(strip_schema).parquet(*paths).groupBy(*keys, "side").agg(
                F.max_by(F.struct("d", "f", "nth"), "nth").alias("s")).select(*keys, "side", "s.*")
            through_table(aged, path)
            written[-AGED:] = [(age, path)]
        strips = spark.read.schema(strip_schema).parquet(*[p for _, p in written])
        regions = news.select(*keys).distinct()
        nine = F.array(*[F.struct((F.col("rc") + dx).alias("rc"), (F.col("rr") + dy).alias("rr")) for dx, dy in [*SIDES, (0, 0)]])
        around = regions.select(*others, F.explode(nine).alias("at")).select("at.*", *others).distinct()
        active = ringed(of_regions(regions, changed)).join(starts, ["rc", "rr"], "left")
        # a region has eight strips at most, the longest along its sides, and no more than were ever written
        work = met(active, keys, min(total, 8 * changed * (64 + 16 * max(at.w, at.h))) + start_bytes)
        nth += 1
    held = latest(strips) if strips is not None else news.drop("nth")
    reached = met(ringed(held), keys, min(total, held.agg(strip_bytes).first()[0]) if total > BROADCAST_BYTES else total, "left")
    small = start_bytes <= BROADCAST_BYTES
    whole = reached.join(F.broadcast(starts) if small else starts.hint("merge"), ["rc", "rr"], "left")
    whole = whole.where("starts IS NOT NULL OR strips IS NOT NULL")
    types |= dict(tiles.df.dtypes)
    done = whole.select(*columns).mapInArrow(
        fill, ", ".join([*(f"{k} {types[k]}" for k in ("col", "row", *others)), "d array<double>"]))
    return tiles.with_df(done.select("col", "row", *others, F.array("d").alias("bands")),
                         cell_type=CellType.parse("float64"), bands=1)


def _friction(tiles: DataFrame, at: _Regions, band: int, keys: list[str], others: list[str], path: str) -> DataFrame:
    """One row per region with data: the friction of its cells, from at most kx * ky tiles."""
    piece = F.struct(((F.col("col") % at.kx) * at.tc).alias("px"), ((F.col("row") % at.ky) * at.tr).alias("py"),
                     F.lit(at.tc).alias("w"), F.lit(at.tr).alias("h"),
                     F.get("bands", F.lit(band)).cast("array<double>").alias("vals"))
    pieces = (tiles.select(*at.of_tile(), *others, piece.alias("piece"))
              .groupBy(*keys).agg(F.collect_list("piece").alias("pieces")))
    types = dict(pieces.dtypes)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), TOGETHER):
                some = batch.slice(first, TOGETHER)
                whole = padded_windows(pa.concat_arrays([some.column("pieces")]), at.h, at.w, 0)
                yield pa.RecordBatch.from_arrays([*[some.column(k) for k in keys], nullable_lists(
                    whole.reshape(len(some), at.h * at.w))], [*keys, "f"])

    return through_table(pieces.mapInArrow(assemble, ", ".join([*(f"{k} {types[k]}" for k in keys), "f array<double>"])), path)
