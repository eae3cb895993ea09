"""Union of layers and stacking of bands."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Layer
from .shape import to_tiles


def union_layers(layers: Sequence[Layer]) -> Layer:
    """All rows of all layers, duplicates kept; zoom of the first."""
    first = layers[0]
    if any((t.kind, t.meta.temporal, t.meta.epsg) != (first.kind, first.meta.temporal,
                                                      first.meta.epsg) for t in layers):
        raise ValueError("layers differ in shape, time or CRS")
    kind = reduce(lambda a, b: a.union(b), [t.meta.cell_type for t in layers])
    extents = [t.meta.extent for t in layers if t.meta.extent]
    meta = replace(first.meta, cell_type=kind, bands=max(t.meta.bands for t in layers),
                   extent=reduce(lambda a, b: a.combine(b), extents) if extents else None,
                   bounds=None)
    typed = [t.df.withColumn("v", F.col("v").cast(kind.compute_type)) if t.kind == "cell" else
             t.df.withColumn("bands", F.col("bands").cast(f"array<array<{kind.compute_type}>>"))
             for t in layers]
    return Layer(reduce(DataFrame.unionByName, typed), meta, first.kind)


def combine_bands(layers: Sequence[Layer]) -> Layer:
    """Bands of all layers stacked in layer order, per key of any layer.

    A key that a layer lacks gets fewer bands. A key that occurs twice in one layer is an error.
    The state per key is one slot per layer, so no list is gathered.
    """
    if layers[0].kind != "scene":
        layers = [to_tiles(layer) for layer in layers]
    first = layers[0]
    kind = reduce(lambda a, b: a.union(b), [t.meta.cell_type for t in layers])
    array = f"array<array<{kind.compute_type}>>"
    # scenes belong together when extent, CRS and time agree; the lowest id is kept
    ids = ["scene_id"] if first.kind == "scene" else []
    keys = (first.keys if first.kind == "tile" else
            [c for c in first.df.columns if c not in ("bands", "scene_id")])
    tagged = [t.df.select(*keys, *ids, F.lit(i).alias("nth"),
                          F.col("bands").cast(array).alias("bands"))
              for i, t in enumerate(layers)]
    slots = [F.min(c).alias(c) for c in ids]
    for i in range(len(layers)):
        mine = F.col("nth") == i
        slots += [F.any_value(F.when(mine, F.col("bands")), True).alias(f"bands{i}"),
                  F.count(F.when(mine, True)).alias(f"n{i}")]
    grouped = reduce(DataFrame.unionByName, tagged).groupBy(*keys).agg(*slots)
    empty = F.array().cast(array)
    parts = [F.when(F.col(f"n{i}") > 1, F.raise_error(F.lit("duplicate key in a layer")).cast(array))
             .otherwise(F.coalesce(F.col(f"bands{i}"), empty)) for i in range(len(layers))]
    return first.with_df(grouped.select(*ids, *keys, F.concat(*parts).alias("bands")), cell_type=kind,
                         bands=sum(t.meta.bands for t in layers))
