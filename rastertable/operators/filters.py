"""Selections by time, key and place."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import search_tree
from ..model import Layer
from ..plans.joins import lookup_join

Moment = str | datetime


def moment(t: Moment) -> Column:
    text = t.isoformat(sep=" ") if isinstance(t, datetime) else t
    return F.to_timestamp_ntz(F.lit(text))


def _moment_key(t: Moment) -> datetime:
    return t if isinstance(t, datetime) else datetime.fromisoformat(t)


def time_predicate(times: Sequence[Moment], column: str = "instant") -> Column:
    """The list is read in pairs, inclusive at both ends; a lone last value must match exactly.

    Overlapping ranges are merged first, and many ranges are searched as a tree, so that the
    predicate is a plain expression that can reach the scan.
    """
    points = [_moment_key(t) for t in times]
    if not points:
        raise ValueError("no times given")
    pairs = sorted((points[i], points[min(i + 1, len(points) - 1)])
                   for i in range(0, len(points), 2))
    merged: list[tuple[datetime, datetime]] = []
    for start, end in pairs:
        if start > end:
            raise ValueError(f"range ends before it starts: {start} > {end}")
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    at = F.col(column)
    inside = search_tree(merged, lambda i: at < moment(merged[i][0]),
                         lambda r: at.between(moment(r[0]), moment(r[1])))
    if len(merged) == 1:
        return inside
    return at.between(moment(merged[0][0]), moment(max(e for _, e in merged))) & inside


def filter_by_times(layer: Layer, times: Sequence[Moment]) -> Layer:
    """Rows whose instant lies in any of the ranges; scenes, tiles and cells alike."""
    if not layer.meta.temporal:
        raise ValueError("the layer has no time")
    kept = Layer(layer.base.where(time_predicate(times)), layer.meta, layer.kind, layer.pending)
    return kept


def to_spatial(layer: Layer, instant: Moment | None = None) -> Layer:
    """Drop time: one time slice, or all rows, after which keys may repeat (merge or aggregate)."""
    df = layer.df if instant is None else layer.df.where(F.col("instant") == moment(instant))
    return layer.with_df(df.drop("instant"), temporal=False)


def lookup(layer: Layer, col: int, row: int) -> DataFrame:
    """All tiles of one key."""
    return layer.df.where((F.col("col") == col) & (F.col("row") == row))


def lookup_many(layer: Layer, requested: DataFrame) -> DataFrame:
    """Tiles of the requested (col, row) keys."""
    wanted = requested.select(F.col("col").cast("int"), F.col("row").cast("int")).distinct()
    # the range of the keys is a predicate that reaches the scan
    c0, c1, r0, r1 = wanted.agg(F.min("col"), F.max("col"), F.min("row"), F.max("row")).first()
    if c0 is None:
        return layer.df.where("false")
    tiles = layer.df.where(F.col("col").between(c0, c1) & F.col("row").between(r0, r1))
    return lookup_join(tiles, wanted, ["col", "row"], "left_semi", 16,
                       ["instant"] if layer.meta.temporal else None)


def filter_by_keys(layer: Layer, tiles: DataFrame) -> Layer:
    """Tiles whose key is in ``tiles``."""
    return layer.with_df(lookup_many(layer, tiles))
