"""Map algebra over tiled rasters as Spark DataFrames."""

import sys

from pyspark import cloudpickle

from .functions.classes import ColorMap
from .functions.neighborhoods import Annulus, Circle, Nesw, Square, Wedge, neighborhood
from .functions.projection import transform_extent, transform_xy
from .model import (CellType, Extent, GlobalLayout, Layer, Layout, LocalLayout, Meta, from_cells,
                    from_scenes, from_tiles, global_level)
from .operators.aggregate import (aggregate_by_cell, collect_metadata, color_map_from_histogram,
                                  color_map_from_quantiles, combine_summaries, histogram_approx, histogram_exact,
                                  histogram_from_json, histogram_to_json, merge, min_max,
                                  quantile_breaks, quantile_breaks_exact,
                                  quantile_breaks_of_histogram, raster_summary)
from .operators.cost import cost_distance
from .operators.distance import euclidean_distance
from .operators.filters import (filter_by_keys, filter_by_times, lookup, lookup_many, to_spatial)
from .operators.focal import aspect, focal, hillshade, slope, tobler
from .operators.geometry import (coverage_spans, edges_from_rings, extent_edges, polygon_spans, segment_cells,
                                 tiles_for_geometry, tiles_for_points)
from .operators.local import (color_map, composite, convert, local_abs, local_add, local_add_all,
                              local_divide, local_multiply, local_pow, local_subtract, normalize,
                              r_local_divide, r_local_pow, r_local_subtract, reclassify,
                              render_rgba, select_bands, with_sentinels, without_sentinels)
from .operators.rasterize import rasterize, rasterize_coverage, rasterize_on, rasterize_single
from .operators.requests import read_tiles_zoomed
from .operators.resample import (pyramid, pyramid_cells, reproject, resample,
                                 resample_to_power_of_two, stitch_cells, tile_to_layout)
from .operators.sets import combine_bands, union_layers
from .operators.shape import grid, keys, to_cells, to_tiles
from .operators.zonal import (crop, filter_by_geometry, histogram_series, mask, max_series,
                              mean_series, min_series, point_values, polygonal_max, polygonal_mean,
                              polygonal_min, polygonal_sum, polygonal_summary, polygonal_weighted,
                              sum_series)
from .sources.catalog import Catalog
from .sources.scenes import export_scenes, read_scenes, split_scenes

# Functions that run in tasks travel with them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Layer.__add__ = Layer.__radd__ = local_add
Layer.__sub__ = local_subtract
Layer.__rsub__ = r_local_subtract
Layer.__mul__ = Layer.__rmul__ = local_multiply
Layer.__truediv__ = local_divide
Layer.__rtruediv__ = r_local_divide
Layer.__pow__ = local_pow
Layer.__rpow__ = r_local_pow
Layer.__abs__ = local_abs
