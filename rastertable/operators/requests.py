"""Batches of tile requests answered by one join, static or streaming."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import Layer
from ..plans.joins import BROADCAST_BYTES, split_join
from .shape import to_tiles

#: Types whose values take 16 bytes at most.
FIXED = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz")


def read_tiles_zoomed(requests: DataFrame, levels: Sequence[Layer], max_zoom: int | None = None,
                      overzoom: bool = True) -> DataFrame:
    """Tiles for requests (zoom, x, y), other columns kept; requests without a tile give no row.

    A request above ``max_zoom`` takes the part of its ancestor tile that it covers, enlarged to a
    full tile, or nothing without ``overzoom``. Needs no state, so requests may be a stream.

    Of a batch, each level's smallest and largest keys are found first: only the levels asked for are
    read, and of these the keys in between, a range that reaches the scan of stored tiles. In a stream
    that takes a look at each micro-batch, as ``streaming.tiles.serve_requests`` does.
    """
    tiles = [to_tiles(level) for level in levels]
    top = max_zoom if max_zoom is not None else max(level.zoom for level in tiles)
    at = tiles[0].meta.layout
    asked = requests if overzoom else requests.where(F.col("zoom") <= top)
    dz = F.greatest(F.col("zoom") - top, F.lit(0)).cast("int")
    shift = lambda c: F.call_function("shiftright", F.col(c).cast("bigint"), dz)
    asked = asked.withColumns({"_dz": dz, "_zoom": F.least(F.col("zoom"), F.lit(top)).cast("int"),
                               "_col": shift("x").cast("int"), "_row": shift("y").cast("int")})
    on = ["_zoom", "_col", "_row"]
    found = None if requests.isStreaming else _asked_boxes(asked, requests.columns)
    parts = []
    for t in tiles:
        df = t.df
        if found is not None:
            box = found[0].get(t.zoom)
            if box is None:
                continue
            df = df.where(F.col("col").between(*box[:2]) & F.col("row").between(*box[2:]))
        parts.append(df.select(F.lit(t.zoom).alias("_zoom"), F.col("col").alias("_col"), F.col("row").alias("_row"),
                               *(["instant"] if t.meta.temporal else []), "bands"))
    if not parts:  # no level is asked for
        parts = [tiles[0].df.where("false").select(
            F.lit(0).alias("_zoom"), F.col("col").alias("_col"), F.col("row").alias("_row"),
            *(["instant"] if tiles[0].meta.temporal else []), "bands")]
    table = reduce(DataFrame.unionByName, parts)
    if found is None:
        met = table.join(asked, on)
    elif found[1] <= BROADCAST_BYTES:
        met = table.join(F.broadcast(asked), on)
    else:  # many requests for one tile are split
        met = split_join(table, asked, on, "inner", ["instant"] if "instant" in table.columns else on, requests.columns)

    def source(i: Column) -> Column:
        """Position in the ancestor tile of cell ``i`` of the requested tile."""
        fine_x = (F.col("x") - F.call_function("shiftleft", F.col("_col").cast("bigint"),
                                               F.col("_dz"))) * at.tile_cols + i % at.tile_cols
        fine_y = (F.col("y") - F.call_function("shiftleft", F.col("_row").cast("bigint"),
                                               F.col("_dz"))) * at.tile_rows + F.floor(
            i / at.tile_cols)
        sx = F.call_function("shiftright", fine_x, F.col("_dz"))
        sy = F.call_function("shiftright", fine_y, F.col("_dz"))
        return (sy * at.tile_cols + sx).cast("int")

    cells = F.sequence(F.lit(0), F.lit(at.tile_cells - 1))
    enlarged = F.transform("bands", lambda band: F.transform(
        cells, lambda i: F.get(band, source(i))))
    out = met.withColumn("bands", F.when(F.col("_dz") == 0, F.col("bands")).otherwise(enlarged))
    return out.drop("_dz", "_zoom", "_col", "_row")


def _asked_boxes(asked: DataFrame, columns: list[str]) -> tuple[dict[int, tuple], int]:
    """Per zoom first and last column and row asked for, and a bound on the bytes of all requests."""
    texts = [c for c, t in asked.dtypes if c in columns and t not in FIXED]
    wide = sum((F.coalesce(F.length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0)) for c in texts), F.lit(64 + 16 * len(columns)))
    rows = asked.where("_zoom IS NOT NULL").groupBy("_zoom").agg(
        F.min("_col"), F.max("_col"), F.min("_row"), F.max("_row"), F.sum(wide)).collect()  # one row per zoom
    return {r[0]: tuple(r)[1:5] for r in rows if None not in tuple(r)[1:5]}, sum(r[5] for r in rows)
