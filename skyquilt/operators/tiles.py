"""Raster tiles: names, overlap with boxes, and sliding tile grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NAME = r"(?i)^([NS])(\d{2})([EW])(\d{3})\.tif$"


def tile_corner(name: Column) -> tuple[Column, Column]:
    """West and south of a one-degree tile's name, in any case; null for other names."""
    part = [F.regexp_extract(name, _NAME, k) for k in range(5)]
    ok = part[0] != ""
    sign = lambda x, minus: F.when(F.upper(x) == minus, -1).otherwise(1)
    return tuple(F.when(ok, v.try_cast("int") * sign(s, m)) for s, v, m in ((part[3], part[4], "W"), (part[1], part[2], "S")))


def tile_overlap(tiles: DataFrame, boxes: DataFrame) -> DataFrame:
    """name and id of tiles and boxes that share area; touching doesn't count.

    Boxes are cut into the whole degrees they touch, which makes the range join an equi-join.
    """
    west, south = tile_corner(F.col("name"))
    named = tiles.select("name", west.alias("min_lon"), south.alias("min_lat")).where("min_lon is not null").distinct()
    cut = lambda lo, hi: F.explode(F.sequence(F.floor(lo).cast("int"), F.floor(hi).cast("int")))
    cells = boxes.select("*", cut("x0", "x1").alias("min_lon")).select("*", cut("y0", "y1").alias("min_lat"))
    hit = named.join(cells, ["min_lon", "min_lat"])
    return hit.where("min_lon < x1 and min_lon + 1 > x0 and min_lat < y1 and min_lat + 1 > y0").select("name", "id")


def _steps(low: str, high: str, size: float, step: float) -> Column:
    """How many tiles begin at low, low + step and so on, before high - size + step / 2; none, if the extent is too small."""
    n = F.ceil((F.col(high) - size + step / 2 - F.col(low)) / step)
    return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.array().cast("array<bigint>"))


def tile_grid(extents: DataFrame, size: float, step: float) -> DataFrame:
    """id, ix, iy, x0 and y0 of the square tiles over each extent (id, x0, y0, x1, y1)."""
    rows = extents.select("id", "x0", "y0", "y1", F.explode(_steps("x0", "x1", size, step)).alias("ix"))
    rows = rows.select("id", "ix", "x0", "y0", F.explode(_steps("y0", "y1", size, step)).alias("iy"))
    return rows.select("id", "ix", "iy", (F.col("x0") + F.col("ix") * step).alias("x0"), (F.col("y0") + F.col("iy") * step).alias("y0"))


def first_names(tiles: DataFrame, n: int = 6) -> list[str]:
    """What a log line shows of a selection: its first names, and an ellipsis if there are more."""
    names = [r["name"] for r in tiles.select("name").distinct().orderBy("name").limit(n + 1).collect()]
    return names[:n] + ["..."] * (len(names) > n)
