"""Resampling kernels as column expressions of the distance to the sample, in cells."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Method name -> half-width of its kernel in cells.
SUPPORT = {"Bilinear": 1, "CubicConvolution": 2, "CubicSpline": 2, "Lanczos": 3}

# Smallest weight the data cells around a point must carry. Kernels with negative
# lobes need a good part of it, or renormalising would magnify values.
LEAST_WEIGHT = {"Bilinear": 1e-9, "CubicConvolution": 0.3, "CubicSpline": 1e-9, "Lanczos": 0.3}

# Names of the aggregating methods.
AGGREGATES = ("Average", "Mode", "Median", "Max", "Min")


def negative_lobes(method: str) -> bool:
    """Whether weights can be negative; where data cells carry too little, bilinear weights count."""
    return method in ("CubicConvolution", "Lanczos")


def support(method: str) -> int:
    if method not in SUPPORT:
        raise ValueError(f"no point kernel named {method!r}")
    return SUPPORT[method]


def least_weight(method: str) -> float:
    return LEAST_WEIGHT[method]


def kernel_weight(method: str, distance: Column) -> Column:
    """Weight of a sample: linear tent, cubic convolution with a = -1/2 (Keys 1981), cubic
    B-spline, or windowed sinc with three lobes (Lanczos)."""
    d = F.abs(distance)
    if method == "Bilinear":
        return F.greatest(F.lit(1.0) - d, F.lit(0.0))
    if method == "CubicConvolution":
        near = (1.5 * d - 2.5) * d * d + 1.0
        far = ((-0.5 * d + 2.5) * d - 4.0) * d + 2.0
        return F.when(d < 1, near).when(d < 2, far).otherwise(0.0)
    if method == "CubicSpline":
        near = (3.0 * d * d * d - 6.0 * d * d + 4.0) / 6.0
        far = (2.0 - d) * (2.0 - d) * (2.0 - d) / 6.0
        return F.when(d < 1, near).when(d < 2, far).otherwise(0.0)
    if method == "Lanczos":
        x = d * math.pi
        return (F.when(d < 1e-12, 1.0)
                .when(d < 3, 3.0 * F.sin(x) * F.sin(x / 3.0) / (x * x)).otherwise(0.0))
    raise ValueError(f"no point kernel named {method!r}")


def kernel_array(method: str, distance: np.ndarray) -> np.ndarray:
    """``kernel_weight`` over numpy arrays."""
    d = np.abs(distance)
    if method == "Bilinear":
        return np.maximum(1.0 - d, 0.0)
    if method == "CubicConvolution":
        near, far = (1.5 * d - 2.5) * d * d + 1.0, ((-0.5 * d + 2.5) * d - 4.0) * d + 2.0
        return np.where(d < 1, near, np.where(d < 2, far, 0.0))
    if method == "CubicSpline":
        near, rest = (3.0 * d * d * d - 6.0 * d * d + 4.0) / 6.0, 2.0 - d
        return np.where(d < 1, near, np.where(d < 2, rest * rest * rest / 6.0, 0.0))
    if method == "Lanczos":
        x = np.maximum(d, 1e-12) * np.pi
        return np.where(d < 1e-12, 1.0, np.where(d < 3, 3.0 * np.sin(x) * np.sin(x / 3.0) / (x * x), 0.0))
    raise ValueError(f"no point kernel named {method!r}")
