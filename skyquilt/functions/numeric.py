"""Numeric Column functions that keep NULL and NaN apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(x: Column) -> Column:
    """False for NaN, which Spark sorts above every number, and for null."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def half_even(x: Column) -> Column:
    return F.rint(x).cast("long")


def clip(x: Column, low, high) -> Column:
    """Nulls stay null."""
    low, high = (v if isinstance(v, Column) else F.lit(v) for v in (low, high))
    return F.when(x.isNotNull(), F.least(F.greatest(x, low), high))


def stretch(x: Column, low: Column, high: Column) -> Column:
    """0 to 255 between two percentiles at least one apart, cut off to an integer; NaN is 0."""
    return F.when(F.isnan(x), F.lit(0)).otherwise(F.floor(clip((x - low) / F.greatest(high - low, F.lit(1.0)), 0.0, 1.0) * 255).cast("int"))


def confidence(residual: Column, threshold: float) -> Column:
    return clip(1 - residual / (4 * threshold + 1e-6), 0.05, 1.0)


def inverse_confidence(conf: Column) -> Column:
    """What match sets carry as their residual: at least 1, and not a number of pixels."""
    return 1 / F.greatest(conf, F.lit(1e-6))


def world_to_pixel(x: Column, y: Column, affine: tuple[float, float, float, float]) -> tuple[Column, Column]:
    """Column and row of a point for an affine of origin (c, f) and cell (a, e)."""
    c, a, f, e = affine
    return (x - c) / a, (y - f) / e
