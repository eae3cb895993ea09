"""Small rasters as numpy arrays (NaN = NoData) and back."""

from __future__ import annotations

import numpy as np

import rastertable as rt


def layout(rows: int, cols: int, tile: int = 4, cell: float = 1.0) -> rt.Layout:
    lr, lc = -(-rows // tile), -(-cols // tile)
    return rt.Layout(rt.Extent(0.0, -lr * tile * cell, lc * tile * cell, 0.0), lc, lr, tile, tile)


def cell_layer(spark, *bands: np.ndarray, tile: int = 4, cell: float = 1.0,
               cell_type: str | None = None, epsg: int = 3857) -> rt.Layer:
    kind = cell_type or ("float64" if any(b.dtype.kind == "f" and not np.all(
        np.isnan(b) | (b == np.round(b))) for b in bands) else "int32")
    cast = float if kind.startswith("float") else int
    rows = [(int(x), int(y), n, cast(b[y, x])) for n, b in enumerate(bands)
            for y in range(b.shape[0]) for x in range(b.shape[1]) if not np.isnan(b[y, x])]
    df = spark.createDataFrame(rows, "x bigint, y bigint, band int, v "
                               + ("double" if cast is float else "bigint"))
    meta = rt.Meta(rt.CellType.parse(kind), layout(*bands[0].shape, tile, cell), epsg, len(bands))
    return rt.from_cells(df, meta)


def as_array(layer: rt.Layer, rows: int, cols: int, band: int = 0) -> np.ndarray:
    out = np.full((rows, cols), np.nan)
    for r in rt.to_cells(layer).df.where(f"band = {band}").collect():
        assert np.isnan(out[r["y"], r["x"]]), "cell occurs twice"
        out[r["y"], r["x"]] = r["v"]
    return out


def random_raster(rows: int, cols: int, seed: int = 0, gaps: float = 0.3, top: int = 40):
    rng = np.random.default_rng(seed)
    a = rng.integers(1, top, (rows, cols)).astype(float)
    a[rng.random((rows, cols)) < gaps] = np.nan
    return a
