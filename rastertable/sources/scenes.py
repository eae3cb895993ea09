"""Scenes from files, windowed splitting, and export with extents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.projection import parse_crs
from ..model import CellType, Layer, Meta, from_scenes
from ..operators.local import with_sentinels, without_sentinels
from ..operators.shape import to_tiles

# Default tag and format of acquisition times.
TIME_TAG = "TIFFTAG_DATETIME"
TIME_FORMAT = "yyyy:MM:dd HH:mm:ss"


def read_scenes(spark: SparkSession, paths: str | Sequence[str], temporal: bool = False,
                crs: str | int | None = None, time_tag: str = TIME_TAG,
                time_format: str = TIME_FORMAT, max_tile_size: int | None = None,
                chunk_size: int | None = None, num_partitions: int | None = None,
                cell_type: str = "float64", bands: int = 1, sentinels: bool = True) -> Layer:
    """Scene tables on any Hadoop paths, read together as one layer.

    Rows hold the scene columns and may hold ``tags MAP<STRING,STRING>``: ``time_tag`` names the
    tag the instant is parsed from. ``crs`` replaces the CRS of all rows. ``max_tile_size`` and
    ``chunk_size`` (the smaller one counts) split big scenes into windows. With ``sentinels`` the
    NoData value of the cell type is read as NULL.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.parquet(*paths)
    forced = parse_crs(crs)
    if forced is not None:
        df = df.withColumn("epsg", F.lit(forced))
    if temporal and "instant" not in df.columns:
        df = df.withColumn("instant", F.to_timestamp_ntz(F.col("tags")[time_tag],
                                                         F.lit(time_format)))
    meta = Meta(CellType.parse(cell_type), None, forced or 0, bands, temporal=temporal)
    layer = from_scenes(df, meta)
    if sentinels:
        layer = without_sentinels(layer)
    limits = [n for n in (max_tile_size, chunk_size) if n]
    if limits:
        layer = split_scenes(layer, min(limits))
    if num_partitions:
        layer = layer.with_df(layer.df.repartition(num_partitions))
    return layer


def split_scenes(layer: Layer, size: int) -> Layer:
    """Every scene as windows of at most ``size`` x ``size`` cells with extents of their own."""
    starts = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1, F.lit(size)))
    df = layer.df.withColumn("_x", starts("cols")).withColumn("_y", starts("rows"))
    # names of their own: inside a lambda, a name also given in the same select means the new one
    df = df.withColumnsRenamed({"cols": "_cols", "rows": "_rows"})
    w = F.least(F.lit(size), F.col("_cols") - F.col("_x"))
    h = F.least(F.lit(size), F.col("_rows") - F.col("_y"))
    cw = (F.col("xmax") - F.col("xmin")) / F.col("_cols")
    ch = (F.col("ymax") - F.col("ymin")) / F.col("_rows")
    lines = F.sequence(F.col("_y"), F.col("_y") + h - 1)
    cut = F.transform("bands", lambda band: F.flatten(F.transform(
        lines, lambda y: F.slice(band, y * F.col("_cols") + F.col("_x") + 1, w))))
    keep = ["scene_id", "epsg"] + (["instant"] if layer.meta.temporal else [])
    return layer.with_df(df.select(
        *keep, (F.col("xmin") + F.col("_x") * cw).alias("xmin"),
        (F.col("ymax") - (F.col("_y") + h) * ch).alias("ymin"),
        (F.col("xmin") + (F.col("_x") + w) * cw).alias("xmax"),
        (F.col("ymax") - F.col("_y") * ch).alias("ymax"),
        w.cast("int").alias("cols"), h.cast("int").alias("rows"), cut.alias("bands")))


def _tag_map(tags: Mapping[str, str]):
    entries = [F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in tags.items()]
    if not entries:
        return F.create_map().cast("map<string,string>")
    return F.map_from_entries(F.array(*entries))


def export_scenes(layer: Layer, head_tags: Mapping[str, str] | None = None,
                  band_tags: Sequence[Mapping[str, str]] | None = None,
                  path: str | None = None, sentinels: bool = False) -> DataFrame:
    """One row per tile with its extent, CRS and tags; written as Parquet when a path is given.

    Head and band tags are independent of each other. ``sentinels`` writes NULL as the NoData value
    of the cell type.
    """
    tiles = with_sentinels(to_tiles(layer)) if sentinels else to_tiles(layer)
    at = layer.meta.layout
    rows = tiles.df.select(
        *tiles.keys, *at.tile_extent(F.col("col"), F.col("row")),
        F.lit(layer.meta.epsg).alias("epsg"), F.lit(at.tile_cols).alias("cols"),
        F.lit(at.tile_rows).alias("rows"), _tag_map(head_tags or {}).alias("tags"),
        F.array(*[_tag_map(t) for t in band_tags or []]).cast("array<map<string,string>>")
        .alias("band_tags"), "bands")
    if path:
        rows.write.mode("overwrite").parquet(path)
        return layer.base.sparkSession.read.parquet(path)
    return rows
