"""Rasters as cell tables (raster_id, row, col, value): density, opening, runs, crops, stretches and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.functions.geodesy import utm_forward, utm_inverse
from skyquilt.functions.numeric import clip, stretch


def window(cells: DataFrame, row0: int, col0: int, height: int, width: int) -> DataFrame:
    """A windowed read: a filter that reaches the scan."""
    return cells.where(F.col("row").between(row0, row0 + height - 1) & F.col("col").between(col0, col0 + width - 1))


def densify(cells: DataFrame) -> DataFrame:
    """Every row by every column of each raster's extent; the cells that are missing are null."""
    span = cells.groupBy("raster_id").agg(*(f(c).alias(f"{n}_{c}") for c in ("row", "col") for n, f in (("lo", F.min), ("hi", F.max))))
    grid = span.select("raster_id", F.explode(F.expr("sequence(lo_row, hi_row)")).alias("row"), "lo_col", "hi_col").select("raster_id", "row", F.explode(F.expr("sequence(lo_col, hi_col)")).alias("col"))
    return grid.join(cells, ["raster_id", "row", "col"], "left")


def block_average(cells: DataFrame, factor: int) -> DataFrame:
    """Means of factor by factor blocks; sizes that are multiples of ``factor`` give the decimated read exactly."""
    at = lambda c: F.floor(F.col(c) / factor).alias(c)
    return cells.groupBy("raster_id", at("row"), at("col")).agg(F.avg("value").alias("value"))


def _sweep(df: DataFrame, by: list[str], along: str, reach: int, f, column: str) -> DataFrame:
    """``f`` over the cells at most ``reach`` from each along one axis; range frames, so that gaps are gaps."""
    return df.withColumn(column, f(column).over(Window.partitionBy(*by).orderBy(along).rangeBetween(-reach, reach)))


def opening(cells: DataFrame, size: int, axes: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """Erosion and then dilation by a square of an odd ``size``, cut off at the border; below 3 the cells as they are.

    Each is a pass per axis, as a square's minimum is that of its rows' minima.
    """
    if size < 3:
        return cells
    if size % 2 == 0:
        raise ValueError("the size is odd")
    for f in (F.min, F.max):
        for axis in axes:
            rest = [c for c in ("raster_id", "row", "col") if c != axis and c in cells.columns]
            cells = _sweep(cells, rest, axis, size // 2, f, "value")
    return cells


def density(cells: DataFrame, axis: str, brighter_than: float) -> DataFrame:
    """raster_id, ``axis`` and density, the share of its cells above a brightness."""
    lit = F.coalesce(F.col("value") > brighter_than, F.lit(False)).cast("int")
    return cells.groupBy("raster_id", axis).agg(F.avg(lit).alias("density"))


def longest_run(profile: DataFrame, key: str, index: str, good: Column) -> DataFrame:
    """``key``, start and stop (exclusive) of the longest run of consecutive indices that are good; the first of equal ones.

    Keys without a good index have no row.
    """
    w = Window.partitionBy(key)
    lit = profile.where(good).withColumn("_island", F.col(index) - F.row_number().over(w.orderBy(index)))
    runs = lit.groupBy(key, "_island").agg(F.min(index).alias("start"), (F.max(index) + 1).alias("stop"))
    return runs.withColumn("_r", F.row_number().over(w.orderBy(F.desc(F.col("stop") - F.col("start")), "start"))).where("_r = 1").select(key, "start", "stop")


def require_run(runs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The runs, with an error for a key that has none."""
    missing = F.raise_error(F.concat(F.lit("no run in "), F.col(key).cast("string")))
    return keys.select(key).distinct().join(runs, key, "left").withColumn("start", F.when(F.col("start").isNull(), missing).otherwise(F.col("start")))


def refine_edges(profile: DataFrame, key: str, index: str, good: Column) -> DataFrame:
    """``key``, first good index and one past the last."""
    return profile.groupBy(key).agg(F.min(F.when(good, F.col(index))).alias("first"), (F.max(F.when(good, F.col(index))) + 1).alias("past"))


def shrink(low: Column, high: Column, margin: int, limit: Column) -> tuple[Column, Column]:
    """An interval moved inwards by a margin and cut to 0 and ``limit``; null if nothing is left."""
    a, b = F.greatest(low + margin, F.lit(0)), F.least(high - margin, limit)
    return F.when(a < b, a), F.when(a < b, b)


def crop_windows(cells: DataFrame, brighter_than: float, dense: float, margin: int, size: int = 7, coverage: float = 0.5, factor: int = 1, refine: bool = True) -> DataFrame:
    """raster_id, row0, row1, col0, col1: opening, densities, the longest dense run on both axes, a coverage gate, refined edges and a margin.

    The runs are found on means of ``factor`` by ``factor`` blocks. An edge is then refined at full resolution, on a slab
    around it that leaves out 15 % of the other axis at either end; without a dense index there it stays. Rasters without
    a dense run on both axes, with a run below ``coverage`` of the extent, or that the margin uses up have no row.
    """
    coarse = opening(cells if factor == 1 else block_average(cells, factor), size)
    box = cells.groupBy("raster_id").agg(*(x for c in ("row", "col") for x in (F.min(c).alias(f"lo_{c}"), (F.max(c) + 1).alias(f"hi_{c}"))))
    for axis in ("row", "col"):
        profile = density(coarse, axis, brighter_than)
        run = longest_run(profile, "raster_id", axis, F.col("density") >= dense)
        span = profile.groupBy("raster_id").agg(F.min(axis).alias("lo"), (F.max(axis) + 1).alias("hi"))
        one = run.join(span, "raster_id").where((F.col("stop") - F.col("start")) >= coverage * (F.col("hi") - F.col("lo")))
        box = box.join(one.select("raster_id", (F.col("start") * factor).alias(f"{axis}0"), (F.col("stop") * factor).alias(f"{axis}1")), "raster_id")
    edges, out, reach = box, box, max(32, 4 * factor)
    for axis, other in (("row", "col"), ("col", "row")) if refine else ():
        low, extent = F.col(f"lo_{other}"), F.col(f"hi_{other}") - F.col(f"lo_{other}")
        inner = (F.col(other) >= low + F.floor(extent * 0.15)) & (F.col(other) < low + F.floor(extent * 0.85))
        for end, past in ((f"{axis}0", "first"), (f"{axis}1", "past")):
            near = (F.col(axis) >= F.col(end) - reach) & (F.col(axis) < F.col(end) + reach)
            slab = cells.join(edges, "raster_id").where(inner & near).select("raster_id", "row", "col", "value")
            found = refine_edges(density(opening(slab, size), axis, brighter_than), "raster_id", axis, F.col("density") >= dense)
            out = out.join(found.select("raster_id", F.col(past).alias("_at")), "raster_id", "left").withColumn(end, F.coalesce("_at", end)).drop("_at")
    for axis in ("row", "col"):
        a, b = shrink(F.col(f"{axis}0"), F.col(f"{axis}1"), margin, F.col(f"hi_{axis}"))
        out = out.withColumns({f"{axis}0": a, f"{axis}1": b}).where(F.col(f"{axis}0").isNotNull())
    return out.select("raster_id", "row0", "row1", "col0", "col1")


def percentile_stretch(cells: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """raster_id, row, col and byte, stretched between each raster's exact percentiles; NaN counts in none and becomes 0."""
    known = F.when(~F.isnan("value"), F.col("value"))
    edge = cells.groupBy("raster_id").agg(F.percentile(known, F.array(F.lit(low), F.lit(high))).alias("p"))
    return cells.join(edge, "raster_id").select("raster_id", "row", "col", stretch(F.col("value"), F.col("p")[0], F.col("p")[1]).alias("byte"))


def nearest_sample(points: DataFrame, cells: DataFrame) -> DataFrame:
    """``points`` (id, raster_id, r, c) with the value of the cell they fall in, cut towards zero; outside, null."""
    at = points.withColumns({"row": F.when(F.col("r") > -1, F.col("r")).cast("long"), "col": F.when(F.col("c") > -1, F.col("c")).cast("long")})
    return at.join(cells, ["raster_id", "row", "col"], "left").select("id", "raster_id", "r", "c", "value")


def bilinear_sample(points: DataFrame, cells: DataFrame, sizes: DataFrame, half_open: bool = False) -> DataFrame:
    """``points`` (id, raster_id, r, c) with the value between the four cells around them.

    ``sizes``: raster_id, height, width. The domain is 0 to size - 1, the upper end in or, if ``half_open``,
    out. The next neighbour is cut to the edge. Outside, or with a null cell among the four, null; NaN stays NaN.
    """
    top = lambda x, n: (F.col(x) < F.col(n) - 1) if half_open else (F.col(x) <= F.col(n) - 1)
    inside = points.join(sizes, "raster_id").where((F.col("r") >= 0) & (F.col("c") >= 0) & top("r", "height") & top("c", "width"))
    fr, fc = F.col("r") - F.floor("r"), F.col("c") - F.floor("c")
    r0, c0 = F.floor("r"), F.floor("c")
    r1, c1 = F.least(r0 + 1, F.col("height") - 1), F.least(c0 + 1, F.col("width") - 1)
    corner = lambda r, c, w: F.struct(r.cast("long").alias("row"), c.cast("long").alias("col"), w.alias("w"))
    four = F.array(corner(r0, c0, (1 - fr) * (1 - fc)), corner(r0, c1, (1 - fr) * fc), corner(r1, c0, fr * (1 - fc)), corner(r1, c1, fr * fc))
    parts = inside.select("id", "raster_id", F.inline(four)).join(cells, ["raster_id", "row", "col"])
    sums = parts.groupBy("id", "raster_id").agg(F.sum(F.col("value") * F.col("w")).alias("value"), F.count("value").alias("n")).where("n = 4").drop("n")
    return points.join(sums, ["id", "raster_id"], "left").select("id", "raster_id", "r", "c", "value")


def reproject(cells: DataFrame, source: tuple[float, float, float, float], source_zone: int, grid: DataFrame, target: tuple[float, float, float, float], target_zone: int, is_north: bool = True) -> DataFrame:
    """The cells of ``grid`` (raster_id, row, col) in another zone, with the value of the source cell in which their middles fall.

    ``source`` and ``target``: origin x, cell width, origin y, cell height of the rasters; outside the source the value is null.
    """
    x = F.lit(target[0]) + (F.col("col") + 0.5) * F.lit(target[1])
    y = F.lit(target[2]) + (F.col("row") + 0.5) * F.lit(target[3])
    lon, lat = utm_inverse(x, y, F.lit(target_zone), F.lit(is_north))
    at = grid.select("raster_id", "row", "col", lon.alias("_lon"), lat.alias("_lat"))
    east, north = utm_forward(F.col("_lon"), F.col("_lat"), F.lit(source_zone))
    at = at.select("raster_id", "row", "col", F.floor((east - source[0]) / source[1]).alias("_c"), F.floor((north - source[2]) / source[3]).alias("_r"))
    held = cells.select("raster_id", F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    return at.join(held, ["raster_id", "_r", "_c"], "left").select("raster_id", "row", "col", "value")


def sample_grid(low: int, high: int, step: int) -> list[int]:
    """low, low + step and so on below high, and high - 1 in any case."""
    own = list(range(low, high, step))
    return own + [high - 1] * (bool(own) and own[-1] != high - 1)


def byte_clip(x: Column) -> Column:
    return clip(x, 0.0, 255.0).cast("int")
