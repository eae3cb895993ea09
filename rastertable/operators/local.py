"""Cell-wise map algebra. NoData in, NoData out; operations with constants need no shuffle.

Integer layers stay integer with integer operands and become float64 with any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import ColorMap, class_of
from ..model import INTEGER_BITS, CellType, Layer
from .fold import fold_tiles, unflatten
from .shape import to_tiles

Number = int | float


def _result_type(layer: Layer, operand_is_integer: bool) -> str:
    return "float64" if layer.is_floating or not operand_is_integer else "int32"


def _operands(layer: Layer, c: Number):
    """Result type, the cast for the cell and the literal for the constant."""
    kind = _result_type(layer, isinstance(c, int))
    spark = CellType.parse(kind).compute_type
    lit = F.lit(c).cast(spark)
    if spark == layer.meta.cell_type.compute_type:
        return kind, (lambda v: v), lit
    return kind, (lambda v: v.cast(spark)), lit


def _divide(a: Column, b: Column, integer: bool) -> Column:
    """Quotient, NULL for a zero divisor; integer quotients truncate toward zero."""
    q = F.try_divide(a.cast("double"), b.cast("double"))
    return q.cast("bigint") if integer else q


def _power(a: Column, b: Column, integer: bool) -> Column:
    """Power, NULL when not finite. Integer results need a non-negative exponent."""
    p = F.pow(a.cast("double"), b.cast("double"))
    finite = F.when(~F.isnan(p) & (F.abs(p) != F.lit(float("inf"))), p)
    return finite.try_cast("bigint") if integer else finite


def _same_type(a: Layer, b: Layer) -> str:
    return "float64" if a.is_floating or b.is_floating else "int32"


def _pair(a: Layer, b: Layer, op, cell_type: str) -> Layer:
    """Inner join of two layers by key, bands zipped and cut to the shorter list."""
    if (a.kind == "cell") != (b.kind == "cell"):
        a, b = to_tiles(a), to_tiles(b)
    spark = CellType.parse(cell_type).compute_type
    run = lambda v, w: op(v.cast(spark), w.cast(spark))
    if a.kind == "cell":
        joined = a.df.join(b.df.withColumnRenamed("v", "w"), a.keys, "inner")
        out = joined.select(*a.keys, run(F.col("v"), F.col("w")).alias("v"))
        return a.with_df(out.where(F.col("v").isNotNull()), cell_type=CellType.parse(cell_type))
    joined = a.df.join(b.df.withColumnRenamed("bands", "others"), a.keys, "inner")
    n = F.least(F.size("bands"), F.size("others"))
    zipped = F.zip_with(F.slice("bands", F.lit(1), n), F.slice("others", F.lit(1), n),
                        lambda p, q: F.zip_with(p, q, run))
    return a.with_df(joined.select(*a.keys, zipped.alias("bands")),
                     cell_type=CellType.parse(cell_type),
                     bands=min(a.meta.bands, b.meta.bands))


def local_add(layer: Layer, other: Number | Layer | Sequence[Layer]) -> Layer:
    """``v + c``, ``v + w``, or the sum of this layer and all layers of a list."""
    if isinstance(other, Layer):
        return _pair(layer, other, lambda v, w: v + w, _same_type(layer, other))
    if not isinstance(other, (int, float)):
        return local_add_all([layer, *other])
    kind, cast, c = _operands(layer, other)
    return layer.map_cells(lambda v: cast(v) + c, kind)


def local_subtract(layer: Layer, other: Number | Layer) -> Layer:
    """``v - c`` or ``v - w``."""
    if isinstance(other, Layer):
        return _pair(layer, other, lambda v, w: v - w, _same_type(layer, other))
    kind, cast, c = _operands(layer, other)
    return layer.map_cells(lambda v: cast(v) - c, kind)


def r_local_subtract(layer: Layer, c: Number) -> Layer:
    """``c - v``."""
    kind, cast, lit = _operands(layer, c)
    return layer.map_cells(lambda v: lit - cast(v), kind)


def local_multiply(layer: Layer, other: Number | Layer) -> Layer:
    """``v * c`` or ``v * w``."""
    if isinstance(other, Layer):
        return _pair(layer, other, lambda v, w: v * w, _same_type(layer, other))
    kind, cast, c = _operands(layer, other)
    return layer.map_cells(lambda v: cast(v) * c, kind)


def local_divide(layer: Layer, other: Number | Layer) -> Layer:
    """``v / c`` or ``v / w``; integers divide as integers, a zero divisor gives NoData."""
    if isinstance(other, Layer):
        kind = _same_type(layer, other)
        return _pair(layer, other, lambda v, w: _divide(v, w, kind == "int32"), kind)
    kind, cast, c = _operands(layer, other)
    return layer.map_cells(lambda v: _divide(cast(v), c, kind == "int32"), kind)


def r_local_divide(layer: Layer, c: Number) -> Layer:
    """``c / v``."""
    kind, cast, lit = _operands(layer, c)
    return layer.map_cells(lambda v: _divide(lit, cast(v), kind == "int32"), kind)


def local_pow(layer: Layer, other: Number | Layer) -> Layer:
    """``v ** c`` or ``v ** w``. Integer results only for a non-negative integer exponent."""
    if isinstance(other, Layer):
        return _pair(layer, other, lambda v, w: _power(v, w, False), "float64")
    whole = isinstance(other, int) and other >= 0 and not layer.is_floating
    return layer.map_cells(lambda v: _power(v, F.lit(other), whole),
                           "int32" if whole else "float64", reads_once=False)


def r_local_pow(layer: Layer, c: Number) -> Layer:
    """``c ** v``, always float64."""
    return layer.map_cells(lambda v: _power(F.lit(c), v, False), "float64", reads_once=False)


def local_abs(layer: Layer) -> Layer:
    """Absolute value."""
    return layer.map_cells(F.abs)


def normalize(layer: Layer, old_min: float, old_max: float, new_min: float,
              new_max: float) -> Layer:
    """Linear rescale ``new_min + (v - old_min) * (new_max - new_min) / (old_max - old_min)``."""
    span, scale = float(old_max - old_min), float(new_max - new_min)
    return layer.map_cells(
        lambda v: F.lit(float(new_min)) + (v - F.lit(float(old_min))) * scale / span, "float64")


def local_add_all(layers: Sequence[Layer]) -> Layer:
    """Sum over the layers that have the key; NoData in any of these tiles gives NoData.

    Bands are cut to the shortest list.
    """
    tiles = [to_tiles(layer) for layer in layers]
    first = tiles[0]
    kind = CellType.parse("float64" if any(t.is_floating for t in tiles) else "int32")
    bands = min(t.meta.bands for t in tiles)
    n = first.meta.layout.tile_cells
    flat = [t.df.select(*first.keys, F.flatten(F.slice("bands", 1, bands)).cast(f"array<{kind.compute_type}>")
                        .alias("flat")) for t in tiles]
    summed = fold_tiles(reduce(DataFrame.unionByName, flat), first.keys, F.col("flat"), n * bands,
                        "Sum", kind.compute_type)
    return first.with_df(summed.select(*first.keys, unflatten(
        n, bands, kind.compute_type).alias("bands")), cell_type=kind, bands=bands)


def composite(layers: Sequence[Layer], blend=None) -> Layer:
    """Layers at the same key, combined cell by cell; a key must exist in every layer.

    The default blend is "over": the first layer in order that has data wins. Another blend is a
    function of the cell columns of two layers, applied from left to right.
    """
    blend = blend or F.coalesce
    tiles = [to_tiles(layer) for layer in layers]
    kind = reduce(lambda a, b: a.union(b), [t.meta.cell_type for t in tiles])
    return reduce(lambda a, b: _pair(a, b, blend, str(kind)), tiles)


def reclassify(layer: Layer, breaks: Mapping[Number, Number], boundary: str = "LessThanOrEqualTo",
               replace_nodata_with: Number | None = None, double: bool = False) -> Layer:
    """Value -> class value. No break hit -> NoData; NoData -> ``replace_nodata_with``.

    The integer variant truncates values first. Replacing NoData needs full tiles, so a cell layer
    is turned into tiles then.
    """
    kind = CellType.parse("float64" if double else "int32")
    if replace_nodata_with is not None:
        layer = to_tiles(layer)

    def run(v: Column) -> Column:
        value = v if double or not layer.is_floating else v.cast("bigint")
        found = class_of(value, breaks, boundary, kind.compute_type)
        if replace_nodata_with is None:
            return found
        return F.when(v.isNull(), F.lit(replace_nodata_with).cast(kind.compute_type)
                      ).otherwise(found)

    return layer.map_cells(run, kind, reads_once=False)


def color_map(layer: Layer, colors: ColorMap) -> Layer:
    """RGBA colour of every cell of the tiles, NoData cells included."""
    return to_tiles(layer).map_cells(colors.column, "uint16", reads_once=False)


def render_rgba(layer: Layer, colors: ColorMap | None = None, render=None) -> DataFrame:
    """Tiles of colours: key and one RGBA array from band 0.

    ``render`` may be any function from the cell column to a colour column.
    """
    paint = render or colors.column
    tiles = to_tiles(layer)
    return tiles.df.select(
        *tiles.keys, F.transform(F.get("bands", F.lit(0)), lambda v: paint(v)).alias("rgba"))


def convert(layer: Layer, cell_type: str) -> Layer:
    """Change the cell type: truncate toward zero, wrap out-of-range integers as a narrowing cast
    does, NaN and infinities become NoData. The metadata changes along."""
    kind = CellType.parse(cell_type)

    def run(v: Column) -> Column:
        if kind.floating:
            return v.cast("float").cast("double") if kind.name == "float32" else v.cast("double")
        whole = v.try_cast("bigint") if layer.is_floating else v
        if kind.name == "bool":
            return (whole != 0).cast("bigint")
        bits = INTEGER_BITS[kind.name]
        low = F.pmod(whole, F.lit(1 << bits).cast("bigint"))
        if not kind.signed:
            return low
        half = F.lit(1 << (bits - 1)).cast("bigint")
        return F.pmod(low + half, F.lit(1 << bits).cast("bigint")) - half

    return layer.map_cells(run, kind)


def without_sentinels(layer: Layer) -> Layer:
    """NoData values of the cell type (and NaN) become NULL: for rows that come from files."""
    nodata = layer.meta.cell_type.nodata

    def run(v: Column) -> Column:
        if not layer.is_floating:
            return v if nodata is None else F.nullif(v, F.lit(nodata).cast("bigint"))
        data = ~F.isnan(v)
        if nodata is not None and nodata == nodata:
            data = data & (v != F.lit(float(nodata)))
        return F.when(data, v)

    return layer.map_cells(run, reads_once=False)


def with_sentinels(layer: Layer) -> Layer:
    """NULL becomes the NoData value of the cell type: for rows that leave for files."""
    nodata = layer.meta.cell_type.nodata
    if nodata is None:
        return layer
    value = F.lit(nodata).cast(layer.meta.cell_type.compute_type)
    return to_tiles(layer).map_cells(lambda v: F.coalesce(v, value))


def select_bands(layer: Layer, bands: int | Sequence[int]) -> Layer:
    """Bands by index; the order of the list is the order of the result, repeats allowed."""
    wanted = [bands] if isinstance(bands, int) else list(bands)
    if any(b < 0 or b >= layer.meta.bands for b in wanted):
        raise ValueError(f"bands {wanted} of a layer with {layer.meta.bands}")
    if layer.kind == "cell":
        places = F.create_map(*[F.lit(x) for old in sorted(set(wanted)) for x in (
            old, [new for new, b in enumerate(wanted) if b == old])])
        out = (layer.df.where(F.col("band").isin(sorted(set(wanted))))
               .withColumn("band", F.explode(places[F.col("band")])))
        return layer.with_df(out.select(*layer.keys, "v"), bands=len(wanted))
    picked = F.array(*[F.get("bands", F.lit(b)) for b in wanted])
    return layer.with_df(layer.df.withColumn("bands", picked), bands=len(wanted))
