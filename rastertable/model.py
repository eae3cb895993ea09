"""Data model: cell types, extents, layouts, layer metadata and the ``Layer`` itself.

A layer is a DataFrame in one of three shapes plus a small driver-side record:

``scene``  scene_id, epsg, xmin, ymin, xmax, ymax, [instant], cols, rows, bands ARRAY<ARRAY<..>>
``tile``   col, row, [instant], bands ARRAY<ARRAY<..>>           (NULL element = NoData)
``cell``   x, y, [instant], band, v                              (absent row = NoData)

``x`` and ``y`` count cells from the layout's north-west corner, row 0 is north.
Integer layers compute in BIGINT and the others in DOUBLE; ``instant`` is TIMESTAMP_NTZ and
means UTC, so that no result depends on the session time zone.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cell type name -> (Spark storage type, default NoData value).
CELL_TYPES = {
    "bool": ("boolean", None),
    "int8": ("tinyint", -128),
    "uint8": ("smallint", 0),
    "int16": ("smallint", -32768),
    "uint16": ("int", 0),
    "int32": ("int", -2147483648),
    "float32": ("float", math.nan),
    "float64": ("double", math.nan),
}

# Bits per integer cell type.
INTEGER_BITS = {"bool": 1, "int8": 8, "uint8": 8, "int16": 16, "uint16": 16, "int32": 32}

# World extents of the global layouts.
WORLD = {
    3857: (-20037508.342789244, -20037508.342789244, 20037508.342789244, 20037508.342789244),
    4326: (-180.0, -90.0, 180.0, 90.0),
}


@dataclass(frozen=True)
class CellType:
    """A cell type in one of three NoData variants: ``int16``, ``int16raw``, ``int16ud-9999``."""

    name: str
    nodata: float | None

    @staticmethod
    def parse(text: str) -> CellType:
        match = re.fullmatch(r"(bool|u?int(?:8|16|32)|float(?:32|64))(raw|ud(.+))?", text)
        if not match or match[1] not in CELL_TYPES:
            raise ValueError(f"unknown cell type {text!r}")
        name, variant, value = match.groups()
        if variant == "raw":
            return CellType(name, None)
        if value is not None:
            return CellType(name, float(value) if name.startswith("float") else int(value))
        return CellType(name, CELL_TYPES[name][1])

    @property
    def floating(self) -> bool:
        return self.name.startswith("float")

    @property
    def signed(self) -> bool:
        return not self.name.startswith(("u", "bool"))

    @property
    def compute_type(self) -> str:
        return "double" if self.floating else "bigint"

    @property
    def storage_type(self) -> str:
        return CELL_TYPES[self.name][0]

    def __str__(self) -> str:
        default = CELL_TYPES[self.name][1]
        if self.nodata is None:
            return self.name if default is None else self.name + "raw"
        same = self.nodata == default or (self.floating and math.isnan(self.nodata))
        return self.name if same else f"{self.name}ud{self.nodata:g}"

    def union(self, other: CellType) -> CellType:
        """The type that holds the values of both."""
        if self.name == other.name:
            return self
        if self.floating or other.floating:
            wide = "float64" if "float64" in (self.name, other.name) or not (
                self.floating and other.floating) else "float32"
            return CellType.parse(wide)
        a, b = sorted((self, other), key=lambda t: INTEGER_BITS[t.name])
        if INTEGER_BITS[a.name] < INTEGER_BITS[b.name] and (b.signed or not a.signed):
            return b
        return CellType.parse("int16" if INTEGER_BITS[b.name] <= 8 else "int32")


@dataclass(frozen=True)
class Extent:
    xmin: float
    ymin: float
    xmax: float
    ymax: float

    @property
    def width(self) -> float:
        return self.xmax - self.xmin

    @property
    def height(self) -> float:
        return self.ymax - self.ymin

    def combine(self, other: Extent) -> Extent:
        return Extent(min(self.xmin, other.xmin), min(self.ymin, other.ymin),
                      max(self.xmax, other.xmax), max(self.ymax, other.ymax))


@dataclass(frozen=True)
class Layout:
    """A grid of ``layout_cols`` x ``layout_rows`` tiles of ``tile_cols`` x ``tile_rows`` cells."""

    extent: Extent
    layout_cols: int
    layout_rows: int
    tile_cols: int
    tile_rows: int

    @property
    def cols(self) -> int:
        return self.layout_cols * self.tile_cols

    @property
    def rows(self) -> int:
        return self.layout_rows * self.tile_rows

    @property
    def cell_width(self) -> float:
        return self.extent.width / self.cols

    @property
    def cell_height(self) -> float:
        return self.extent.height / self.rows

    @property
    def tile_cells(self) -> int:
        return self.tile_cols * self.tile_rows

    # --- layout maths as column expressions -------------------------------------------------
    def to_grid(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Map coordinates -> fractional cell coordinates, y pointing south."""
        return ((x - F.lit(self.extent.xmin)) / F.lit(self.cell_width),
                (F.lit(self.extent.ymax) - y) / F.lit(self.cell_height))

    def cell_of(self, x: Column, y: Column) -> tuple[Column, Column]:
        gx, gy = self.to_grid(x, y)
        return F.floor(gx).cast("bigint"), F.floor(gy).cast("bigint")

    def centre_of(self, x: Column, y: Column) -> tuple[Column, Column]:
        return (F.lit(self.extent.xmin) + (x + F.lit(0.5)) * F.lit(self.cell_width),
                F.lit(self.extent.ymax) - (y + F.lit(0.5)) * F.lit(self.cell_height))

    def key_of(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Tile key of a cell."""
        return (F.floor(x / F.lit(self.tile_cols)).cast("int"),
                F.floor(y / F.lit(self.tile_rows)).cast("int"))

    def index_of(self, x: Column, y: Column) -> Column:
        """Zero-based row-major position of a cell in its tile."""
        return (F.pmod(y, F.lit(self.tile_rows)) * F.lit(self.tile_cols)
                + F.pmod(x, F.lit(self.tile_cols))).cast("int")

    def place_of(self, i: Column) -> tuple[Column, Column]:
        """(x, y) in its tile of a row-major position; bit operations for power-of-two widths."""
        n = self.tile_cols
        if n & (n - 1) == 0:
            return i.bitwiseAND(F.lit(n - 1)), F.shiftright(i, n.bit_length() - 1)
        return i % n, F.floor(i / n).cast("int")

    def tile_extent(self, col: Column, row: Column) -> list[Column]:
        w = self.extent.width / self.layout_cols
        h = self.extent.height / self.layout_rows
        xmin = F.lit(self.extent.xmin) + col * F.lit(w)
        ymax = F.lit(self.extent.ymax) - row * F.lit(h)
        return [xmin.alias("xmin"), (ymax - F.lit(h)).alias("ymin"),
                (xmin + F.lit(w)).alias("xmax"), ymax.alias("ymax")]

    # --- driver-side maths -------------------------------------------------------------------
    def key_bounds(self, extent: Extent) -> tuple[int, int, int, int] | None:
        """Tile keys (inclusive) that an extent covers, None where it lies off the layout; east and
        south edges are half-open."""
        fx = self.layout_cols / self.extent.width
        fy = self.layout_rows / self.extent.height
        c0 = math.floor((extent.xmin - self.extent.xmin) * fx)
        r0 = math.floor((self.extent.ymax - extent.ymax) * fy)
        c1 = max(c0, math.ceil((extent.xmax - self.extent.xmin) * fx) - 1)
        r1 = max(r0, math.ceil((self.extent.ymax - extent.ymin) * fy) - 1)
        if c1 < 0 or r1 < 0 or c0 >= self.layout_cols or r0 >= self.layout_rows:
            return None
        clip = lambda v, top: min(max(v, 0), top - 1)
        return (clip(c0, self.layout_cols), clip(r0, self.layout_rows),
                clip(c1, self.layout_cols), clip(r1, self.layout_rows))

    def level(self) -> int:
        """How often the local scheme can halve this layout until one tile is left."""
        return max((self.layout_cols - 1).bit_length(), (self.layout_rows - 1).bit_length())

    def zoom_out(self) -> Layout:
        """Next coarser local level: same extent and tile size, half the tiles, never below one."""
        return replace(self, layout_cols=max(1, -(-self.layout_cols // 2)),
                       layout_rows=max(1, -(-self.layout_rows // 2)))

    def to_dict(self) -> dict:
        return {"extent": asdict(self.extent),
                "tileLayout": {"layoutCols": self.layout_cols, "layoutRows": self.layout_rows,
                               "tileCols": self.tile_cols, "tileRows": self.tile_rows}}

    @staticmethod
    def from_dict(d: dict) -> Layout:
        t = d["tileLayout"]
        return Layout(Extent(**d["extent"]), t["layoutCols"], t["layoutRows"],
                      t["tileCols"], t["tileRows"])


@dataclass(frozen=True)
class LocalLayout:
    """Tiles start at the north-west corner and keep the source resolution."""

    tile_cols: int = 256
    tile_rows: int | None = None

    def layout_for(self, epsg: int, extent: Extent, cell_size: tuple[float, float]):
        tc, tr = self.tile_cols, self.tile_rows or self.tile_cols
        cw, ch = cell_size
        lc = max(1, math.ceil(round(extent.width / cw, 6) / tc))
        lr = max(1, math.ceil(round(extent.height / ch, 6) / tr))
        grown = Extent(extent.xmin, extent.ymax - lr * tr * ch, extent.xmin + lc * tc * cw,
                       extent.ymax)
        return Layout(grown, lc, lr, tc, tr), None


@dataclass(frozen=True)
class GlobalLayout:
    """Power-of-two pyramid over the CRS world extent; ``zoom=None`` takes the best level."""

    tile_size: int = 256
    zoom: int | None = None
    threshold: float = 0.1

    def layout_for(self, epsg: int, extent: Extent, cell_size: tuple[float, float]):
        if epsg not in WORLD:
            raise ValueError(f"no world extent known for EPSG:{epsg}")
        zoom = self.zoom if self.zoom is not None else self.level_for(epsg, cell_size[0])
        return global_level(epsg, zoom, self.tile_size), zoom

    def level_for(self, epsg: int, cell_width: float) -> int:
        world = Extent(*WORLD[epsg]).width
        z0 = max(0, math.floor(math.log2(world / (cell_width * self.tile_size)) + 1e-9))
        here = world / (self.tile_size * 2 ** z0)
        passed = (here - cell_width) / (here - here / 2)
        return z0 + 1 if passed > self.threshold else z0


def global_level(epsg: int, zoom: int, tile_size: int = 256) -> Layout:
    return Layout(Extent(*WORLD[epsg]), 2 ** zoom, 2 ** zoom, tile_size, tile_size)


@dataclass(frozen=True)
class Meta:
    """What is known about a layer without reading it."""

    cell_type: CellType
    layout: Layout | None
    epsg: int
    bands: int
    temporal: bool = False
    zoom: int | None = None
    extent: Extent | None = None
    bounds: dict | None = None

    def to_json(self) -> str:
        return json.dumps({
            "cellType": str(self.cell_type),
            "layoutDefinition": self.layout.to_dict() if self.layout else None,
            "crs": self.epsg, "bands": self.bands, "temporal": self.temporal, "zoom": self.zoom,
            "extent": asdict(self.extent) if self.extent else None,
            "bounds": self.bounds}, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Meta:
        d = json.loads(text)
        return Meta(CellType.parse(d["cellType"]),
                    Layout.from_dict(d["layoutDefinition"]) if d["layoutDefinition"] else None,
                    d["crs"], d["bands"], d["temporal"], d["zoom"],
                    Extent(**d["extent"]) if d["extent"] else None, d["bounds"])


CellFunction = Callable[[Column], Column]


@dataclass(frozen=True)
class Layer:
    """A raster layer: lazily evaluated DataFrame + metadata.

    Cell-wise functions are queued in ``pending`` and run as one expression, so that a chain of
    local operations costs a single pass over the tile arrays.
    """

    base: DataFrame
    meta: Meta
    kind: str
    pending: tuple[CellFunction, ...] = field(default=())

    @property
    def keys(self) -> list[str]:
        if self.kind == "scene":
            head = ["scene_id"]
        else:
            head = ["col", "row"] if self.kind == "tile" else ["x", "y"]
        tail = ["band"] if self.kind == "cell" else []
        return head + (["instant"] if self.meta.temporal else []) + tail

    @property
    def df(self) -> DataFrame:
        if not self.pending:
            return self.base
        chain = self.pending

        def run(v: Column) -> Column:
            for step in chain:
                v = step(v)
            return v

        if self.kind == "cell":
            out = self.base.withColumn("v", run(F.col("v")))
            return out.where(F.col("v").isNotNull())
        return self.base.withColumn(
            "bands", F.transform("bands", lambda band: F.transform(band, run)))

    def with_df(self, df: DataFrame, kind: str | None = None, **changes) -> Layer:
        """The same layer over other rows; keyword arguments replace metadata fields."""
        return Layer(df, replace(self.meta, **changes), kind or self.kind)

    def map_cells(self, fn: CellFunction, cell_type: CellType | str | None = None,
                  reads_once: bool = True) -> Layer:
        """Queue a cell-wise function. ``reads_once=False`` starts a pass of its own, because an
        expression that mentions its input twice would double the chain before it."""
        if isinstance(cell_type, str):
            cell_type = CellType.parse(cell_type)
        meta = replace(self.meta, cell_type=cell_type or self.meta.cell_type)
        if reads_once:
            return Layer(self.base, meta, self.kind, (*self.pending, fn))
        return Layer(Layer(self.df, meta, self.kind, (fn,)).df, meta, self.kind)

    # --- driver-side properties and physical controls ---------------------------------------
    @property
    def zoom(self) -> int | None:
        return self.meta.zoom

    @property
    def is_floating(self) -> bool:
        return self.meta.cell_type.floating

    @property
    def key_class(self) -> str:
        if self.kind == "scene":
            return "TemporalProjectedExtent" if self.meta.temporal else "ProjectedExtent"
        return "SpaceTimeKey" if self.meta.temporal else "SpatialKey"

    def metadata_json(self) -> str:
        return self.meta.to_json()

    def repartition(self, n: int) -> Layer:
        """Hash-partition by key, e.g. once before a chain of layer joins."""
        return self.with_df(self.df.repartition(n, *self.keys))

    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Layer:
        return self.with_df(self.df.persist(level))

    def unpersist(self) -> Layer:
        self.base.unpersist()
        return self


def _require(df: DataFrame, names: Sequence[str], what: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} rows lack the columns {missing}")


def _typed_bands(df: DataFrame, cell_type: CellType) -> DataFrame:
    wanted = f"array<array<{cell_type.compute_type}>>"
    if df.schema["bands"].dataType.simpleString() == wanted:
        return df
    return df.withColumn("bands", F.col("bands").cast(wanted))


def from_tiles(df: DataFrame, meta: Meta) -> Layer:
    """Layer from tile rows and metadata. Rows must be unique per key for joins by key; where they
    are not, a ``priority`` column tells ``merge`` which one to prefer."""
    names = ["col", "row"] + (["instant"] if meta.temporal else []) + ["bands"]
    _require(df, names, "tile")
    names += ["priority"] if "priority" in df.columns else []
    df = df.withColumns({"col": F.col("col").cast("int"), "row": F.col("row").cast("int")})
    return Layer(_typed_bands(df.select(*names), meta.cell_type), meta, "tile")


def from_cells(df: DataFrame, meta: Meta) -> Layer:
    """Layer from cell rows; NULL values are dropped."""
    names = ["x", "y"] + (["instant"] if meta.temporal else []) + ["band", "v"]
    _require(df, names, "cell")
    df = df.select(*names).withColumns({
        "x": F.col("x").cast("bigint"), "y": F.col("y").cast("bigint"),
        "band": F.col("band").cast("int"), "v": F.col("v").cast(meta.cell_type.compute_type)})
    return Layer(df.where(F.col("v").isNotNull()), meta, "cell")


SCENE_COLUMNS = ["scene_id", "epsg", "xmin", "ymin", "xmax", "ymax", "cols", "rows", "bands"]


def from_scenes(df: DataFrame, meta: Meta) -> Layer:
    """Layer from untiled scenes, each with an extent and CRS of its own."""
    names = SCENE_COLUMNS + (["instant"] if meta.temporal else [])
    _require(df, names, "scene")
    return Layer(_typed_bands(df.select(*names), meta.cell_type), meta, "scene")
