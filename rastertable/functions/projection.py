"""Closed-form coordinate transforms: EPSG:4326, 3857 and UTM on WGS 84 (326xx, 327xx).

The formulas (Snyder 1987) are written once over ``m``, which is either
``pyspark.sql.functions`` for columns or ``math`` for driver-side numbers. ``bind`` gives a name to
an intermediate value that is used several times: by default the value itself, on a DataFrame a
column of its own (``with_transformed``), so that expressions stay small enough to be compiled.
"""

from __future__ import annotations

import math

# WGS 84 and UTM constants.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
UTM_SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

E2 = FLATTENING * (2 - FLATTENING)
EP2 = E2 / (1 - E2)


def utm_zone(epsg: int) -> tuple[int, bool] | None:
    """(zone, is_south) of a UTM code."""
    base, zone = epsg // 100, epsg % 100
    if base in (326, 327) and 1 <= zone <= 60:
        return zone, base == 327
    return None


def supported(epsg: int) -> bool:
    return epsg in (4326, 3857) or utm_zone(epsg) is not None


def parse_crs(text: str | int | None) -> int | None:
    """EPSG code of a CRS given as number, ``EPSG:n``, a proj string with ``+init=epsg:n``, or that of
    longitude and latitude or a UTM zone. None for no text; other text is an error."""
    if text is None or str(text).strip() == "":
        return None
    words = str(text).lower().replace("+init=", "").replace("epsg:", "").split()
    if words[0].isdigit():
        return int(words[0])
    parts = dict(w.lstrip("+").partition("=")[::2] for w in words)
    if parts.get("proj") == "longlat":
        return 4326
    zone = parts.get("zone", "")
    if parts.get("proj") == "utm" and zone.isdigit() and 1 <= int(zone) <= 60:
        return (32700 if "south" in parts else 32600) + int(zone)
    raise ValueError(f"unknown coordinate reference system {text!r}")


def _meridian_arc(phi, m):
    e4, e6 = E2 ** 2, E2 ** 3
    return SEMI_MAJOR * ((1 - E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
                         - (3 * E2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * m.sin(2 * phi)
                         + (15 * e4 / 256 + 45 * e6 / 1024) * m.sin(4 * phi)
                         - (35 * e6 / 3072) * m.sin(6 * phi))


def _itself(value):
    return value


def _to_utm(lon, lat, zone, south, m, bind=_itself):
    rad = math.pi / 180
    phi, lam = bind(lat * rad), (lon - (zone * 6 - 183)) * rad
    s, c, t = bind(m.sin(phi)), bind(m.cos(phi)), bind(m.tan(phi))
    n = bind(SEMI_MAJOR / m.sqrt(1 - E2 * s * s))
    t2, cc, a = bind(t * t), bind(EP2 * c * c), bind(c * lam)
    x = UTM_SCALE * n * (a + (1 - t2 + cc) * a * a * a / 6
                         + (5 - 18 * t2 + t2 * t2 + 72 * cc - 58 * EP2) * a * a * a * a * a / 120)
    y = UTM_SCALE * (_meridian_arc(phi, m) + n * t * (
        a * a / 2 + (5 - t2 + 9 * cc + 4 * cc * cc) * a * a * a * a / 24
        + (61 - 58 * t2 + t2 * t2 + 600 * cc - 330 * EP2) * a * a * a * a * a * a / 720))
    return x + FALSE_EASTING, y + (FALSE_NORTHING_SOUTH if south else 0.0)


def _from_utm(x, y, zone, south, m, bind=_itself):
    deg = 180 / math.pi
    root = math.sqrt(1 - E2)
    e1 = (1 - root) / (1 + root)
    arc = (y - (FALSE_NORTHING_SOUTH if south else 0.0)) / UTM_SCALE
    mu = bind(arc / (SEMI_MAJOR * (1 - E2 / 4 - 3 * E2 ** 2 / 64 - 5 * E2 ** 3 / 256)))
    phi = bind(mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * m.sin(2 * mu)
           + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * m.sin(4 * mu)
           + (151 * e1 ** 3 / 96) * m.sin(6 * mu) + (1097 * e1 ** 4 / 512) * m.sin(8 * mu))
    s, c, t = bind(m.sin(phi)), bind(m.cos(phi)), bind(m.tan(phi))
    w = bind(1 - E2 * s * s)
    n, r = bind(SEMI_MAJOR / m.sqrt(w)), bind(SEMI_MAJOR * (1 - E2) / (w * m.sqrt(w)))
    cc, t2 = bind(EP2 * c * c), bind(t * t)
    d = bind((x - FALSE_EASTING) / (n * UTM_SCALE))
    d2 = bind(d * d)
    lat = phi - n * t / r * (
        d2 / 2 - (5 + 3 * t2 + 10 * cc - 4 * cc * cc - 9 * EP2) * d2 * d2 / 24
        + (61 + 90 * t2 + 298 * cc + 45 * t2 * t2 - 252 * EP2 - 3 * cc * cc) * d2 * d2 * d2 / 720)
    lon = (d - (1 + 2 * t2 + cc) * d2 * d / 6
           + (5 - 2 * cc + 28 * t2 - 3 * cc * cc + 8 * EP2 + 24 * t2 * t2) * d2 * d2 * d / 120) / c
    return lon * deg + (zone * 6 - 183), lat * deg


def transform(x, y, source: int, target: int, m=math, bind=_itself):
    """Coordinates in another CRS. Unknown codes raise an error."""
    if source == target:
        return x, y
    for epsg in (source, target):
        if not supported(epsg):
            raise ValueError(f"EPSG:{epsg} is not supported")
    rad = math.pi / 180
    if source == 3857:
        lon = x / (SEMI_MAJOR * rad)
        lat = (m.atan(m.exp(y / SEMI_MAJOR)) * 2 - math.pi / 2) / rad
    elif source == 4326:
        lon, lat = x, y
    else:
        lon, lat = (bind(v) for v in _from_utm(x, y, *utm_zone(source), m, bind))
    if target == 4326:
        return lon, lat
    if target == 3857:
        return (lon * (SEMI_MAJOR * rad),
                m.log(m.tan(lat * (rad / 2) + math.pi / 4)) * SEMI_MAJOR)
    return _to_utm(lon, lat, *utm_zone(target), m, bind)


def transform_xy(x, y, source: int, target: int):
    """Column form of ``transform``."""
    from pyspark.sql import functions as F
    return transform(x, y, source, target, F)


def with_transformed(df, x, y, source: int, target: int, names: tuple[str, str]):
    """``df`` with the transformed coordinates as columns of the given names.

    Intermediate values become columns on the way. The result comes out of a generator of one row,
    which keeps the optimizer from copying the formulas into filters on the result.
    """
    from pyspark.sql import functions as F

    if source == target:
        return df.withColumns({names[0]: x, names[1]: y})
    made = []

    def bind(value):
        nonlocal df
        made.append(f"_t{len(made)}")
        df = df.withColumn(made[-1], value)
        return F.col(made[-1])

    tx, ty = transform(bind(x), bind(y), source, target, F, bind)
    return df.select("*", F.inline(F.array(F.struct(tx.alias(names[0]), ty.alias(names[1]))))
                     ).drop(*made)


def transform_extent(extent, source: int, target: int, samples: int = 16):
    """Envelope of an extent in another CRS, from points along its border."""
    from ..model import Extent
    if source == target:
        return extent
    steps = [i / samples for i in range(samples + 1)]
    border = ([(extent.xmin + t * extent.width, y) for t in steps
               for y in (extent.ymin, extent.ymax)]
              + [(x, extent.ymin + t * extent.height) for t in steps
                 for x in (extent.xmin, extent.xmax)])
    if target == 3857 and source == 4326:
        top = 85.0511287798066  # fixed value: latitude limit of the square world of EPSG:3857
        border = [(x, max(-top, min(top, y))) for x, y in border]
    moved = [transform(x, y, source, target) for x, y in border]
    xs, ys = [p[0] for p in moved], [p[1] for p in moved]
    return Extent(min(xs), min(ys), max(xs), max(ys))
