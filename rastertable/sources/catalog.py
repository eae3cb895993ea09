"""A catalog of layers on any Hadoop path: Parquet tiles in curve order and a log of attributes.

``<path>/tiles/layer=<name>/zoom=<n>``  tiles with ``key_index``, ranged and sorted by it, so that
                                        files and row groups cover compact areas and key
                                        predicates skip the others
``<path>/attributes``                   (layer, zoom, attr, json, version, deleted), latest wins
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import curves
from ..functions.projection import transform_extent, transform_xy
from ..model import Extent, Layer, Meta
from ..operators.filters import Moment, filter_by_times, moment
from ..operators.shape import to_tiles
from ..operators.zonal import filter_by_geometry

ATTRIBUTES = ("layer string, zoom int, attr string, json string, version bigint, deleted boolean")
CURVES = ("zorder", "hilbert", "rowmajor")
METADATA = "metadata"
INDEX = "index"


@dataclass(frozen=True)
class Catalog:
    spark: SparkSession
    path: str

    def _tiles(self, name: str, zoom: int) -> str:
        return f"{self.path.rstrip('/')}/tiles/layer={name}/zoom={zoom}"

    @property
    def _log_path(self) -> str:
        return f"{self.path.rstrip('/')}/attributes"

    # --- attributes --------------------------------------------------------------------------
    def _append(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, ATTRIBUTES).coalesce(1).write.mode("append").parquet(
            self._log_path)

    def attributes(self) -> DataFrame:
        """Current attributes: (layer, zoom, attr, json)."""
        try:
            log = self.spark.read.schema(ATTRIBUTES).parquet(self._log_path)
        except AnalysisException:
            log = self.spark.createDataFrame([], ATTRIBUTES)
        latest = log.groupBy("layer", "zoom", "attr").agg(
            F.max_by(F.struct("json", "deleted"), "version").alias("last"))
        return latest.where(~F.col("last.deleted")).select("layer", "zoom", "attr", "last.json")

    def _layer_rows(self, name: str, zoom: int) -> DataFrame:
        return self.attributes().where((F.col("layer") == name) & (F.col("zoom") == zoom))

    def read_attribute(self, name: str, zoom: int, attr: str) -> str | None:
        """JSON text of an attribute, None when it is missing."""
        row = self._layer_rows(name, zoom).where(F.col("attr") == attr).first()
        return row["json"] if row else None

    def write_attribute(self, name: str, zoom: int, attr: str, text: str | None) -> None:
        """Set an attribute to JSON text; None changes nothing, other text is an error."""
        if text is None:
            return
        json.loads(text)
        self._append([(name, zoom, attr, text, time.time_ns(), False)])

    def delete_attribute(self, name: str, zoom: int, attr: str) -> None:
        self._append([(name, zoom, attr, None, time.time_ns(), True)])

    def delete_layer(self, name: str, zoom: int) -> None:
        """Forget a layer's attributes; it is no longer listed or readable."""
        now = time.time_ns()
        rows = [(name, zoom, r["attr"], None, now, True)
                for r in self._layer_rows(name, zoom).select("attr").collect()]
        if rows:
            self._append(rows)

    def contains(self, name: str, zoom: int) -> bool:
        return self.read_attribute(name, zoom, METADATA) is not None

    def read_metadata(self, name: str, zoom: int) -> Meta:
        text = self.read_attribute(name, zoom, METADATA)
        if text is None:
            raise KeyError(f"no layer {name!r} at zoom {zoom}")
        return Meta.from_json(text)

    def value_class(self, name: str, zoom: int) -> str:
        """Kind of key of a layer."""
        return "SpaceTimeKey" if self.read_metadata(name, zoom).temporal else "SpatialKey"

    def layer_ids(self) -> DataFrame:
        return self.attributes().where(F.col("attr") == METADATA).select("layer", "zoom")

    # --- layers ------------------------------------------------------------------------------
    def write_layer(self, name: str, layer: Layer, index: str = "zorder",
                    time_unit: str = "days", time_resolution: int = 1,
                    num_partitions: int | None = None,
                    time_bounds: tuple[Moment, Moment] | None = None, time_bits: int = 16) -> None:
        """Write tiles under (name, zoom or 0), in the order of a space-filling curve.

        Time counts in units from the layer's first slot. With ``time_bounds`` (first and last moment)
        the span between them is cut into 2^``time_bits`` slots instead, so that layers written at
        different times share one index; a moment outside is an error.
        """
        tiles = to_tiles(layer)
        meta = replace(layer.meta, zoom=layer.meta.zoom or 0)
        stored = f"array<array<{meta.cell_type.storage_type}>>"
        slots = None
        if meta.temporal and time_bounds is not None:
            slots = TimeSlots.between(*time_bounds, time_bits)
        elif meta.temporal:  # slots count from the layer's first one
            first = tiles.df.agg(F.min(curves.time_slot(F.col("instant"), time_unit, time_resolution))).first()[0] or 0
            slots = TimeSlots(time_unit, time_resolution, first)
        key = key_index(meta, index, slots)
        rows = tiles.df.withColumn("bands", F.col("bands").cast(stored)).withColumn(
            "key_index", key)
        ranged = (rows.repartitionByRange(num_partitions, "key_index") if num_partitions
                  else rows.repartitionByRange("key_index"))
        path = self._tiles(name, meta.zoom)
        ranged.sortWithinPartitions("key_index").write.mode("overwrite").parquet(path)
        # bounds come from the statistics of the written files
        ends = [F.min("col"), F.min("row"), F.max("col"), F.max("row")]
        if meta.temporal:
            ends += [F.min("instant"), F.max("instant")]
        r = self.spark.read.parquet(path).agg(*ends).first()
        bounds = None
        if r[0] is not None:
            bounds = {"minKey": {"col": r[0], "row": r[1]}, "maxKey": {"col": r[2], "row": r[3]}}
            if meta.temporal:
                bounds["minKey"]["instant"], bounds["maxKey"]["instant"] = str(r[4]), str(r[5])
        self.write_attribute(name, meta.zoom, INDEX, json.dumps({"curve": index, "slots": slots and asdict(slots)}))
        self.write_attribute(name, meta.zoom, METADATA, replace(meta, bounds=bounds).to_json())

    def _runs(self, name: str, zoom: int, meta: Meta, keys: tuple[int, int, int, int] | None,
              times: list[Moment] | None) -> Column | None:
        """Runs of the index that hold a box of keys and a span of time, as a predicate."""
        text = self.read_attribute(name, zoom, INDEX)
        if text is None or meta.bounds is None or (keys is None and not (times and meta.temporal)):
            return None
        stored = json.loads(text)
        lo, hi = meta.bounds["minKey"], meta.bounds["maxKey"]
        box = [(lo["col"], hi["col"]), (lo["row"], hi["row"])]
        if keys is not None:
            box = [(max(box[0][0], keys[0]), min(box[0][1], keys[2])), (max(box[1][0], keys[1]), min(box[1][1], keys[3]))]
        if meta.temporal:
            slots = TimeSlots(**stored["slots"])
            held = [datetime.fromisoformat(b["instant"]) for b in (lo, hi)]
            span = [datetime.fromisoformat(moment_text(t)) for t in times] if times else held
            at = self.spark.range(1).select(*[slots.of(moment(t), check=False) for t in (
                max(min(span), held[0]), min(max(span), held[1]))]).first()
            box.append((max(at[0], 0), min(at[1], (1 << 21) - 1)))
        if any(a > b for a, b in box):
            runs = []
        elif stored["curve"] == "rowmajor":
            runs = [(box[1][0] * meta.layout.layout_cols + box[0][0], box[1][1] * meta.layout.layout_cols + box[0][1])]
        else:
            runs = curves.index_runs(stored["curve"], box, curve_bits(meta, stored["curve"]))
        inside = F.lit(False)
        for first, last in runs:
            inside = inside | F.col("key_index").between(first, last)
        return inside

    def read_layer(self, name: str, zoom: int, envelope: Extent | None = None,
                   polygons: DataFrame | None = None, points: DataFrame | None = None,
                   query_epsg: int | None = None, times: list[Moment] | None = None,
                   num_partitions: int | None = None) -> Layer:
        """One layer, limited to an area and to time ranges.

        The envelope becomes a key range, the times a range predicate and both together runs of the curve
        that the tiles are sorted by; all of these reach the scan and skip files and row groups;
        polygons and points are then semi-joined by tile key. ``query_epsg`` is the CRS of the
        query geometry where it differs from the layer's.
        """
        meta = self.read_metadata(name, zoom)
        df = self.spark.read.parquet(self._tiles(name, zoom))
        moved = query_epsg is not None and query_epsg != meta.epsg
        area = bounds = None
        if envelope is not None:
            area = transform_extent(envelope, query_epsg, meta.epsg) if moved else envelope
            bounds = meta.layout.key_bounds(area)
        runs = self._runs(name, zoom, meta, bounds, times)
        df = (df if runs is None else df.where(runs)).drop("key_index")
        layer = Layer(df, meta, "tile")
        if envelope is not None:
            inside = F.lit(False) if bounds is None else (
                F.col("col").between(bounds[0], bounds[2]) & F.col("row").between(bounds[1], bounds[3]))
            layer = layer.with_df(df.where(inside))
        if times and meta.temporal:
            layer = filter_by_times(layer, times)
        if polygons is not None:
            if moved:
                a = transform_xy(F.col("x0"), F.col("y0"), query_epsg, meta.epsg)
                b = transform_xy(F.col("x1"), F.col("y1"), query_epsg, meta.epsg)
                polygons = polygons.withColumns({"x0": a[0], "y0": a[1], "x1": b[0], "y1": b[1]})
            layer = filter_by_geometry(layer, edges=polygons)
        if points is not None:
            if moved:
                x, y = transform_xy(F.col("x"), F.col("y"), query_epsg, meta.epsg)
                points = points.withColumns({"x": x, "y": y})
            layer = filter_by_geometry(layer, points=points)
        wide = f"array<array<{meta.cell_type.compute_type}>>"
        out = layer.df.withColumn("bands", F.col("bands").cast(wide)).select(*layer.keys, "bands")
        return layer.with_df(out.repartition(num_partitions) if num_partitions else out)

    def levels(self, name: str) -> list[Layer]:
        """All zoom levels of a layer, for ``read_tiles_zoomed``."""
        zooms = self.layer_ids().where(F.col("layer") == name).orderBy("zoom").collect()
        return [self.read_layer(name, r["zoom"]) for r in zooms]

    def read_tile(self, name: str, zoom: int, col: int, row: int,
                  instant: Moment | None = None) -> DataFrame:
        """The tile of one key; no row when it is missing."""
        layer = self.read_layer(name, zoom)
        at = (F.col("col") == col) & (F.col("row") == row)
        if instant is not None:
            at = at & (F.col("instant") == moment(instant))
        return layer.df.where(at).limit(1)

    def keys_in_bounds(self, name: str, zoom: int, keys: DataFrame) -> DataFrame:
        """``keys`` (col, row, for layers in time instant) with ``in_bounds``; null keys lie in no bounds."""
        bounds = self.read_metadata(name, zoom).bounds
        if bounds is None:
            return keys.withColumn("in_bounds", F.lit(False))
        lo, hi = bounds["minKey"], bounds["maxKey"]
        inside = F.col("col").between(lo["col"], hi["col"]) & F.col("row").between(lo["row"], hi["row"])
        if "instant" in lo and "instant" in keys.columns:
            inside = inside & F.col("instant").between(moment(lo["instant"]), moment(hi["instant"]))
        return keys.withColumn("in_bounds", F.coalesce(inside, F.lit(False)))

    def in_bounds(self, name: str, zoom: int, col: int, row: int,
                  instant: Moment | None = None) -> bool:
        """Whether a key lies in the bounds of the layer, ends included."""
        bounds = self.read_metadata(name, zoom).bounds
        if bounds is None:
            return False
        lo, hi = bounds["minKey"], bounds["maxKey"]
        if not (lo["col"] <= col <= hi["col"] and lo["row"] <= row <= hi["row"]):
            return False
        if instant is None or "instant" not in lo:
            return True
        at = instant if isinstance(instant, datetime) else datetime.fromisoformat(instant)
        return datetime.fromisoformat(lo["instant"]) <= at <= datetime.fromisoformat(hi["instant"])


@dataclass(frozen=True)
class TimeSlots:
    """Moments as whole numbers for a curve: units of time counted from ``first``, or the span from
    ``start`` to ``end`` (milliseconds since 1970, both included) in 2^``bits`` equal parts."""
    unit: str = "days"
    resolution: int = 1
    first: int = 0
    start: int | None = None
    end: int | None = None
    bits: int = 0

    @staticmethod
    def between(start: Moment, end: Moment, bits: int) -> TimeSlots:
        millis = [round((datetime.fromisoformat(moment_text(t)) - datetime(1970, 1, 1)).total_seconds() * 1000) for t in (start, end)]
        if not 1 <= bits <= 21 or millis[0] > millis[1]:
            raise ValueError("time bounds are in order and have 1 to 21 bits")
        return TimeSlots(start=millis[0], end=millis[1], bits=bits)

    def of(self, instant: Column, check: bool = True) -> Column:
        """The slot of a moment; one that the curve cannot hold is an error, or as it comes without ``check``."""
        if self.start is None:
            slot, most = curves.time_slot(instant, self.unit, self.resolution) - F.lit(self.first), 1 << 21
            text = "more time slots than the curve holds; choose a coarser time unit or resolution"
        else:
            span = self.end - self.start + 1
            passed = curves.epoch_millis(instant) - F.lit(self.start)
            scaled = passed.cast("decimal(20,0)") * F.lit(1 << self.bits).cast("decimal(10,0)")
            slot = F.when(passed < 0, F.lit(-1).cast("bigint")).otherwise(
                F.call_function("div", scaled, F.lit(span).cast("decimal(20,0)")).cast("bigint"))
            most, text = 1 << self.bits, "a moment lies outside the declared time bounds"
        if not check:
            return slot
        return F.when((slot >= 0) & (slot < most), slot).otherwise(F.raise_error(F.lit(text)).cast("bigint"))


def moment_text(at: Moment) -> str:
    return at.isoformat(" ") if isinstance(at, datetime) else str(at)


def curve_bits(meta: Meta, index: str) -> int:
    """Bits per axis of a layer's curve."""
    if meta.temporal:
        return 21
    if index == "hilbert":
        return min(31, (max(meta.layout.layout_cols, meta.layout.layout_rows, 2) - 1).bit_length())
    return 31


def key_index(meta: Meta, index: str, slots: TimeSlots | None = None) -> Column:
    """Curve position of a tile key. Row-major order is for layers without time.

    Time slots must fit the curves' 21 bits; a coarser unit or resolution makes them fit where they do
    not.
    """
    if index not in CURVES:
        raise ValueError(f"unknown index {index!r}")
    col, row = F.col("col"), F.col("row")
    if not meta.temporal:
        if index == "zorder":
            return curves.z_index(col, row)
        if index == "hilbert":
            return curves.hilbert_index([col, row], curve_bits(meta, index))
        return curves.rowmajor_index(col, row, meta.layout.layout_cols)
    if index == "rowmajor":
        raise ValueError("row-major order does not cover time")
    slot = (slots or TimeSlots()).of(F.col("instant"))
    if index == "zorder":
        return curves.z_index(col, row, slot)
    return curves.hilbert_index([col, row, slot], curve_bits(meta, index))
