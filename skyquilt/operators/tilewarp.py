"""Tiles of a raw image against a reference raster, by way of a camera: extents, windows, warps, remaps and matches.

A camera is any object with ``__call__`` (ground points x, y, h to samp, line) and ``ray`` (pixels and heights to x, y), both
on arrays; ``height`` gives the elevation at points x, y, NaN off the elevations. Geometry is relational: a window or an
extent is an aggregate over a few projected points of each tile. What needs a tile's pixels side by side, the matching, is
one group of a cogrouped pandas function, which a tile's side bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyquilt.functions.numeric import is_finite
from skyquilt.operators import matching
from skyquilt.operators.raster import sample_grid

Height = Callable[[np.ndarray], np.ndarray]
#: Points that must project, smallest window of the raw image and of the reference, and its margins in pixels and metres.
LEAST_POINTS, LEAST_RAW, LEAST_REFERENCE, MARGIN_PX, MARGIN_M = 3, 32, 4, 64, 200.0
#: The shortest side of a shrunken tile.
LEAST_SIDE = 8
#: Cells of a side of the blocks by which cells find their windows.
BLOCK = 256


def boundary(images: DataFrame) -> DataFrame:
    """image_id, samp and line of the corners of ``images`` (image_id, width, height) and of the middles of their sides."""
    w, h = F.col("width"), F.col("height")
    at = lambda size: (F.lit(0), F.floor(size / 2), size - 1)
    spots = [(c, r) for j, r in enumerate(at(h)) for i, c in enumerate(at(w)) if (i, j) != (1, 1)]
    points = F.array(*(F.struct(c.cast("double").alias("samp"), r.cast("double").alias("line")) for c, r in spots))
    return images.select("image_id", F.inline(points))


def _extent(points: DataFrame, key: str, least: int) -> DataFrame:
    """x0, y0, x1, y1 of each key's finite points; null if they are fewer than ``least``."""
    good = is_finite(F.col("x")) & is_finite(F.col("y"))
    ends = {"x0": F.min(F.when(good, F.col("x"))), "y0": F.min(F.when(good, F.col("y"))), "x1": F.max(F.when(good, F.col("x"))), "y1": F.max(F.when(good, F.col("y")))}
    rows = points.groupBy(key).agg(*(v.alias(k) for k, v in ends.items()), F.count_if(good).alias("n_points"))
    return rows.select(key, *(F.when(F.col("n_points") >= least, F.col(k)).alias(k) for k in ends), "n_points")


def raw_extents(images: DataFrame, camera, height: Height, strict: bool = True) -> DataFrame:
    """image_id, x0, y0, x1, y1 and n_points: the ground that each image's boundary points span.

    With fewer than LEAST_POINTS that project the extent is null or, if ``strict``, an error. Extents leave NaN out.
    """
    rows = _extent(matching.image_to_ground(boundary(images), camera.ray, height), "image_id", LEAST_POINTS)
    fault = F.raise_error(F.concat(F.lit("too few boundary points on the ground of image "), F.col("image_id").cast("string"))).cast("double")
    return rows.withColumn("x0", F.when(F.col("x0").isNull(), fault).otherwise(F.col("x0"))) if strict else rows


def with_height(points: DataFrame, height: Height) -> DataFrame:
    """``points`` with the elevation h at x, y."""
    kind = T.StructType([*(f for f in points.schema.fields if f.name != "h"), T.StructField("h", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns="h", errors="ignore").assign(h=np.asarray(height(b[["x", "y"]].to_numpy(float)), float))

    return points.mapInPandas(run, kind)


def raw_windows(tiles: DataFrame, camera, height: Height, width: int, lines: int, margin: int = MARGIN_PX) -> DataFrame:
    """tile_id, c0, r0, c1, r1: the raw pixels of each tile (tile_id, x0, y0, x1, y1), from its corners, side middles and centre.

    Cut to the image of ``width`` by ``lines``; null if fewer than LEAST_POINTS project or a side is below LEAST_RAW.
    """
    at = lambda k: (F.col(f"{k}0"), (F.col(f"{k}0") + F.col(f"{k}1")) / 2, F.col(f"{k}1"))
    nine = F.array(*(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x in at("x") for y in at("y")))
    points = matching.ground_to_image(with_height(tiles.select("tile_id", F.inline(nine)), height), camera)
    box = _extent(points.select("tile_id", F.col("samp").alias("x"), F.col("line").alias("y")), "tile_id", LEAST_POINTS)
    low = lambda k: F.greatest(F.lit(0), F.floor(k) - margin)
    high = lambda k, size: F.least(F.lit(size), F.ceil(k) + margin)
    box = box.select("tile_id", low("x0").alias("c0"), low("y0").alias("r0"), high("x1", width).alias("c1"), high("y1", lines).alias("r1"), F.col("x0").isNotNull().alias("seen"))
    fits = F.col("seen") & (F.col("c1") - F.col("c0") >= LEAST_RAW) & (F.col("r1") - F.col("r0") >= LEAST_RAW)
    return box.select("tile_id", *(F.when(fits, F.col(k)).cast("bigint").alias(k) for k in ("c0", "r0", "c1", "r1")))


def reference_windows(extents: DataFrame, origin: tuple[float, float], cell: tuple[float, float], width: int, lines: int, margin: float = MARGIN_M) -> DataFrame:
    """``extents`` (x0, y0, x1, y1) with col_off, row_off, win_w and win_h: the reference's cells under each and a margin.

    ``origin`` is the outer corner of cell 0, 0 and ``cell`` its size, the second one below 0 where rows go south. Offsets are
    rounded down and lengths up; the window is cut to the raster, and null if a side is below LEAST_REFERENCE.
    """
    x = (F.col("x0") - margin - origin[0]) / cell[0], (F.col("x1") + margin - origin[0]) / cell[0]
    y = (F.col("y0") - margin - origin[1]) / cell[1], (F.col("y1") + margin - origin[1]) / cell[1]
    y = y[::-1] if cell[1] < 0 else y
    rows = extents.withColumns({"_c": F.floor(x[0]), "_w": F.ceil(x[1] - x[0]), "_r": F.floor(y[0]), "_h": F.ceil(y[1] - y[0])})
    off = lambda k: F.greatest(F.lit(0), F.col(k))
    size = lambda k, at, most: F.least(F.greatest(F.lit(1), F.col(k) - (off(at) - F.col(at))), F.lit(most) - off(at))
    rows = rows.withColumns({"_cw": size("_w", "_c", width), "_rh": size("_h", "_r", lines)})
    fits = (F.col("_cw") >= LEAST_REFERENCE) & (F.col("_rh") >= LEAST_REFERENCE)
    out = {"col_off": off("_c"), "row_off": off("_r"), "win_w": F.col("_cw"), "win_h": F.col("_rh")}
    return rows.select(*extents.columns, *(F.when(fits, v).cast("bigint").alias(k) for k, v in out.items()))


def cells_of_windows(windows: DataFrame, cells: DataFrame, raster_id) -> DataFrame:
    """tile_id, row, col and value of the cells in each window (tile_id, c0, r0, c1, r1; the ends out).

    Windows and cells meet by blocks of BLOCK cells a side, so that the join is on equal keys.
    """
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / BLOCK), F.floor((F.col(b) - 1) / BLOCK)))
    keyed = windows.where("c0 < c1 and r0 < r1").withColumn("_bc", span("c0", "c1")).withColumn("_br", span("r0", "r1"))
    held = cells.where(F.col("raster_id") == raster_id).select(F.floor(F.col("row") / BLOCK).alias("_br"), F.floor(F.col("col") / BLOCK).alias("_bc"), "row", "col", "value")
    inside = (F.col("col") >= F.col("c0")) & (F.col("col") < F.col("c1")) & (F.col("row") >= F.col("r0")) & (F.col("row") < F.col("r1"))
    return held.join(keyed, ["_br", "_bc"]).where(inside).select("tile_id", "row", "col", "value")


def _axis(low: str, high: str, step: int) -> Column:
    """low, low + step and so on below high, and high - 1."""
    return F.array_distinct(F.concat(F.sequence(F.col(low), F.col(high) - 1, F.lit(step).cast("bigint")), F.array(F.col(high) - 1)))


def sparse_nodes(windows: DataFrame, step: int) -> DataFrame:
    """tile_id, samp and line of every ``step``-th pixel of each window and of its last row and column."""
    rows = windows.where("c0 < c1 and r0 < r1").select("tile_id", F.explode(_axis("c0", "c1", step)).alias("samp"), "r0", "r1")
    rows = rows.select("tile_id", "samp", F.explode(_axis("r0", "r1", step)).alias("line"))
    return rows.select("tile_id", *(F.col(c).cast("double").alias(c) for c in ("samp", "line")))


def dense_warp(windows: DataFrame, nodes: DataFrame, step: int) -> DataFrame:
    """tile_id, row, col, x and y of every pixel of each window, between the four sparse ``nodes`` (with x and y) around it.

    A tile with a node that isn't finite has no rows. The mesh's fields get their four corners by a join, the pixels of a field
    are made from them without one. Joins are sorted ones: Spark takes what is exploded from few windows for few rows, and would
    send all nodes through the driver.
    """
    bad = nodes.where(~(is_finite(F.col("x")) & is_finite(F.col("y")))).select("tile_id").distinct().hint("merge")

    def spans(low: str, high: str) -> Column:
        # From each node to the next; the last one holds the window's last pixel too, and is the only one of a single node.
        n = F.array_sort(_axis(low, high, step))
        pairs = F.arrays_zip(F.slice(n, 1, F.greatest(F.size(n) - 1, F.lit(1))).alias("a"), F.slice(n, F.least(F.size(n), F.lit(2)), F.greatest(F.size(n) - 1, F.lit(1))).alias("b"))
        return F.transform(pairs, lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"), F.when(p["b"] == F.col(high) - 1, p["b"]).otherwise(p["b"] - 1).alias("last")))

    field = windows.where("c0 < c1 and r0 < r1").join(bad, "tile_id", "left_anti").select("tile_id", "c0", "c1", F.explode(spans("r0", "r1")).alias("r"))
    field = field.select("tile_id", "r", F.explode(spans("c0", "c1")).alias("c"))
    corner = lambda k, r, c: F.struct(F.lit(k).alias("k"), r.cast("double").alias("line"), c.cast("double").alias("samp"))
    four = F.array(*(corner(k, F.col(f"r.{i}"), F.col(f"c.{j}")) for k, (i, j) in enumerate((i, j) for i in "ab" for j in "ab")))
    met = field.select("tile_id", "r", "c", F.inline(four)).join(nodes.select("tile_id", "line", "samp", "x", "y").distinct().hint("merge"), ["tile_id", "line", "samp"])
    key = ["tile_id", F.col("r.a").alias("ra"), F.col("r.b").alias("rb"), F.col("r.last").alias("rl"), F.col("c.a").alias("ca"), F.col("c.b").alias("cb"), F.col("c.last").alias("cl")]
    field = met.groupBy(*key).agg(*(F.max(F.when(F.col("k") == k, F.col(v))).alias(f"{v}{k}") for v in "xy" for k in range(4)))
    pixels = field.withColumn("row", F.explode(F.expr("sequence(ra, rl)"))).withColumn("col", F.explode(F.expr("sequence(ca, cl)")))
    part = lambda at, a, b: F.when(F.col(b) > F.col(a), (F.col(at) - F.col(a)) / (F.col(b) - F.col(a))).otherwise(F.lit(0.0))
    fr, fc = part("row", "ra", "rb"), part("col", "ca", "cb")
    mixed = lambda v: F.col(f"{v}0") * (1 - fr) * (1 - fc) + F.col(f"{v}1") * (1 - fr) * fc + F.col(f"{v}2") * fr * (1 - fc) + F.col(f"{v}3") * fr * fc
    return pixels.select("tile_id", "row", "col", mixed("x").alias("x"), mixed("y").alias("y"))


def remap(points: DataFrame, cells: DataFrame) -> DataFrame:
    """``points`` (id, raster_id, r, c) with the value between the four cells around them; a cell that isn't there is 0.

    A point that isn't finite lies outside and gets 0.
    """
    known = is_finite(F.col("r")) & is_finite(F.col("c"))
    r0, c0 = F.floor("r"), F.floor("c")
    fr, fc = F.col("r") - r0, F.col("c") - c0
    corner = lambda r, c, w: F.struct(r.cast("long").alias("row"), c.cast("long").alias("col"), w.alias("w"))
    four = F.array(corner(r0, c0, (1 - fr) * (1 - fc)), corner(r0, c0 + 1, (1 - fr) * fc), corner(r0 + 1, c0, fr * (1 - fc)), corner(r0 + 1, c0 + 1, fr * fc))
    sums = points.where(known).select("id", "raster_id", F.inline(four)).join(cells, ["raster_id", "row", "col"]).groupBy("id", "raster_id").agg(F.sum(F.col("value") * F.col("w")).alias("value"))
    return points.join(sums, ["id", "raster_id"], "left").select("id", "raster_id", "r", "c", F.coalesce("value", F.lit(0.0)).alias("value"))


def shrunken(size: Column, scale: float) -> Column:
    """The side of a tile at another resolution, LEAST_SIDE at least."""
    return F.greatest(F.lit(LEAST_SIDE), F.rint(size * F.lit(float(scale))).cast("bigint"))


def area_resize(cells: DataFrame, sizes: DataFrame) -> DataFrame:
    """raster_id, row, col and value of rasters shrunk by area: each new cell is the mean of what it covers, by area.

    ``sizes``: raster_id, height, width, new_height, new_width, the new ones not above the old ones. Rows and columns count from 0.
    """

    def shares(at: str, size: str, new: str) -> Column:
        scale = F.col(new) / F.col(size)
        a, b = F.col(at) * scale, (F.col(at) + 1) * scale
        first = F.floor(a + 1e-9)
        cut = F.least(first + 1, b)
        one = lambda k, w: F.struct(k.cast("bigint").alias("at"), w.alias("w"))
        return F.filter(F.array(one(first, cut - a), one(first + 1, b - cut)), lambda x: (x["w"] > 1e-9) & (x["at"] < F.col(new)))

    rows = cells.join(sizes, "raster_id")
    rows = rows.select("raster_id", "value", "col", "width", "new_width", F.explode(shares("row", "height", "new_height")).alias("r"))
    rows = rows.select("raster_id", "value", "r", F.explode(shares("col", "width", "new_width")).alias("c"))
    w = F.col("r.w") * F.col("c.w")
    return rows.groupBy("raster_id", F.col("r.at").alias("row"), F.col("c.at").alias("col")).agg((F.sum(F.col("value") * w) / F.sum(w)).alias("value"))


def to_raw(pixel: Column, native: float, match: float, origin: Column | int = 0) -> Column:
    """A coordinate of a tile at the matching resolution as one of the raw image."""
    return pixel / F.lit(float(native) / match) + origin


def consistent(matches: DataFrame, camera, height: Height, limit: float | None) -> DataFrame:
    """``matches`` (with x, y, samp, line) whose ground point projects to within ``limit`` pixels of samp, line; all without a limit.

    Points that don't project go.
    """
    if limit is None:
        return matches
    renamed = with_height(matches.withColumnsRenamed({"samp": "_samp", "line": "_line"}), height)
    back = matching.ground_to_image(renamed, camera)
    off = F.hypot(F.col("samp") - F.col("_samp"), F.col("line") - F.col("_line"))
    near = is_finite(F.col("samp")) & is_finite(F.col("line")) & F.coalesce(off <= limit, F.lit(False))
    return back.where(near).drop("samp", "line", *([] if "h" in matches.columns else ["h"])).withColumnsRenamed({"_samp": "samp", "_line": "line"}).select(*matches.columns)


def round_trips(images: DataFrame, camera, height: Height) -> DataFrame:
    """image_id, error and ok: how far, on the worse axis, an image's middle pixel is from itself by way of the ground.

    ``ok`` is false beyond a pixel, and if the pixel or its ground point doesn't project.
    """
    middle = images.select("image_id", F.floor(F.col("width") / 2).cast("double").alias("samp"), F.floor(F.col("height") / 2).cast("double").alias("line"))
    ground = matching.image_to_ground(middle, camera.ray, height).withColumnsRenamed({"samp": "_samp", "line": "_line"})
    back = matching.ground_to_image(with_height(ground, height), camera)
    error = F.greatest(F.abs(F.col("samp") - F.col("_samp")), F.abs(F.col("line") - F.col("_line")))
    return back.select("image_id", F.when(is_finite(error), error).alias("error"), (is_finite(error) & (error <= 1)).alias("ok"))


def require_round_trips(checks: DataFrame) -> DataFrame:
    """``checks`` of ``round_trips``; an image that isn't ok raises when it is read."""
    fault = F.raise_error(F.concat(F.lit("camera and image differ: "), F.col("image_id").cast("string"))).cast("boolean")
    return checks.withColumn("ok", F.when(F.col("ok"), F.col("ok")).otherwise(fault))


def strongest(points: DataFrame, group: list[str], response: str, ties: list[str], most: int = 8000) -> DataFrame:
    """The keypoints with the largest ``response`` of each group, ``most`` of them."""
    order = Window.partitionBy(*group).orderBy(F.desc(response), *ties)
    return points.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most).drop("_r")


def running_kept(tiles: DataFrame, order: str, kept: str) -> DataFrame:
    """``tiles`` with running, the number kept in all tiles up to each, in order.

    Tiles are dealt by ranges, of which the sums are few, so no task holds all of them.
    """
    from skyquilt.plans.scratch import Scratch

    rows = Scratch(tiles.sparkSession).save(tiles.repartitionByRange(order).withColumn("_p", F.spark_partition_id()))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    per = rows.groupBy("_p").agg(F.sum(kept).alias("_n")).select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_b"))
    here = F.sum(kept).over(Window.partitionBy("_p").orderBy(order))
    return rows.withColumn("_s", here).join(F.broadcast(per), "_p").select(*tiles.columns, (F.col("_s") + F.col("_b")).alias("running"))


def _byte_stretch(a: np.ndarray) -> np.ndarray:
    known = a[np.isfinite(a)]
    if not len(known):
        return np.zeros(a.shape)
    low, high = np.percentile(known, [1, 99])
    return np.floor(np.nan_to_num(np.clip((a - low) / max(high - low, 1.0), 0, 1), nan=0.0) * 255)


def _between(a: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Bilinear values of ``a``; what lies outside counts as 0."""
    framed = np.pad(a, 1)
    r, c = (np.where(np.isfinite(r) & np.isfinite(c), np.clip(x, -1, n), -1.0) + 1 for x, n in ((r, a.shape[0]), (c, a.shape[1])))
    r0, c0 = (np.minimum(np.floor(x).astype(int), n) for x, n in ((r, a.shape[0]), (c, a.shape[1])))
    fr, fc = r - r0, c - c0
    return (framed[r0, c0] * (1 - fr) + framed[r0 + 1, c0] * fr) * (1 - fc) + (framed[r0, c0 + 1] * (1 - fr) + framed[r0 + 1, c0 + 1] * fr) * fc


def _shrink(a: np.ndarray, height: int, width: int) -> np.ndarray:
    def weights(n: int, m: int) -> np.ndarray:
        at = np.arange(n) * m / n
        return np.clip(np.minimum.outer(at + m / n, np.arange(m) + 1.0) - np.maximum.outer(at, np.arange(m, dtype=float)), 0, None).T * n / m / (n / m)

    rows, cols = weights(a.shape[0], height), weights(a.shape[1], width)
    return (rows / rows.sum(1, keepdims=True)) @ a @ (cols / cols.sum(1, keepdims=True)).T


def _grid(own: pd.DataFrame, r0: int, c0: int, r1: int, c1: int, empty: float) -> np.ndarray:
    out = np.full((r1 - r0, c1 - c0), empty)
    out[own["row"].to_numpy() - r0, own["col"].to_numpy() - c0] = own["value"].to_numpy(float)
    return out


Matcher = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
_MATCH = "tile_id long, x double, y double, samp double, line double, mapped_samp double, mapped_line double, confidence double, status string"


def match_raw_tiles(tiles: DataFrame, raw: DataFrame, reference: DataFrame, camera, height: Height, matcher: Matcher, *, raw_size: tuple[int, int], origin: tuple[float, float], cell: tuple[float, float], reference_size: tuple[int, int], step: int = 64, native: float = 4.0, match: float = 10.0, limit: float | None = None) -> DataFrame:
    """tile_id, x, y, samp, line, mapped_samp, mapped_line, confidence and status: each tile's matches between raw image and reference.

    ``tiles``: tile_id, x0, y0, x1, y1; ``raw`` and ``reference``: row, col, value (other columns are ignored), of ``raw_size``
    and ``reference_size`` (width, lines), the reference placed by ``origin`` and ``cell``. A tile's raw window is warped to
    the ground on a sparse grid, the reference is drawn into it, both are shrunk from ``native`` to ``match`` metres and given to
    the ``matcher``, which gives pixels of the one, of the other and confidences. Matches get the ground under the reference's
    pixel; those whose ground projects farther than ``limit`` from the raw pixel go. A tile without matches has one row with
    the first gate that it fails.
    """
    width, lines = raw_size
    windows = raw_windows(tiles.select(F.col("tile_id").cast("long").alias("tile_id"), "x0", "y0", "x1", "y1"), camera, height, width, lines)
    ground = matching.image_to_ground(sparse_nodes(windows, step), camera.ray, height)
    extents = _extent(ground, "tile_id", 1).select("tile_id", *(F.col(k) for k in ("x0", "y0", "x1", "y1")))
    odd = ground.groupBy("tile_id").agg(F.bool_and(is_finite(F.col("x")) & is_finite(F.col("y"))).alias("sparse_finite"))
    wide = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) > matching.EXTENT_M
    # A corrupt camera's extent isn't cut out of the reference.
    cuts = reference_windows(extents.where(~wide), origin, cell, *reference_size)
    plan = windows.join(odd, "tile_id", "left").join(extents.select("tile_id", wide.alias("oversize")), "tile_id", "left").join(cuts.select("tile_id", "col_off", "row_off", "win_w", "win_h"), "tile_id", "left")
    one = lambda df: df.select(F.lit(0).alias("raster_id"), F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("value").cast("double").alias("value"))
    place = cuts.where("col_off is not null").selectExpr("tile_id", "col_off as c0", "row_off as r0", "col_off + win_w as c1", "row_off + win_h as r1")
    pixels = cells_of_windows(windows.where("c0 is not null"), one(raw), 0).withColumn("kind", F.lit(0)).unionByName(cells_of_windows(place, one(reference), 0).withColumn("kind", F.lit(1)))

    def run(key, info: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        tile = key[0]

        def out(status: str, rows=None) -> pd.DataFrame:
            data = np.full((1, 7), np.nan) if rows is None else rows
            return pd.DataFrame(data, columns=["x", "y", "samp", "line", "mapped_samp", "mapped_line", "confidence"]).assign(tile_id=tile, status=status)[[x.split()[0] for x in _MATCH.split(", ")]]

        p = info.iloc[0]
        if not np.isfinite(p["c0"]):
            return out("raw_bbox_invalid")
        c0, r0, c1, r1 = (int(p[k]) for k in ("c0", "r0", "c1", "r1"))
        crop = _grid(own[own["kind"] == 0], r0, c0, r1, c1, 0.0)
        if np.nanmean(crop) < matching.DARK:
            return out("raw_crop_nodata")
        if not p["sparse_finite"]:
            return out("sparse_warp_nonfinite")
        rows, cols = (np.array(sample_grid(a, b, step), float) for a, b in ((r0, r1), (c0, c1)))
        spot = np.stack(np.meshgrid(cols, rows), -1).reshape(-1, 2)
        nodes = matching.locate(spot, camera.ray, height)[0].reshape(len(rows), len(cols), 2)
        x, y = (_dense(rows, cols, nodes[:, :, k], np.arange(r0, r1), np.arange(c0, c1)) for k in (0, 1))
        if (np.isfinite(x) & np.isfinite(y)).mean() < matching.FINITE:
            return out("dense_warp_too_few_finite")
        if p["oversize"]:
            return out("utm_extent_oversize")
        if not np.isfinite(p["col_off"]) or not (own["kind"] == 1).any():
            return out("planet_crop_empty")
        at = [int(p[k]) for k in ("row_off", "col_off", "win_h", "win_w")]
        if max(at[2:]) >= matching.SIDE_PX:
            return out("planet_crop_oversize")
        if max(crop.shape) >= matching.SIDE_PX:
            return out("raw_crop_oversize")
        drawn = _byte_stretch(_grid(own[own["kind"] == 1], at[0], at[1], at[0] + at[2], at[1] + at[3], np.nan))
        warped = np.rint(_between(drawn, (y - origin[1]) / cell[1] - at[0], (x - origin[0]) / cell[0] - at[1]))
        if warped.mean() < matching.DARK:
            return out("warped_planet_nodata")
        scale = native / match
        shown = _byte_stretch(crop)
        if abs(scale - 1) > 1e-3:
            size = [max(LEAST_SIDE, round(n * scale)) for n in crop.shape]
            shown, warped = (_shrink(a, *size) for a in (shown, warped))
        try:
            src, dst, sure = (np.asarray(a, float) for a in matcher(shown, warped))
        except Exception as e:  # noqa: BLE001  a tile's failure is its status
            return out(f"matcher_error:{type(e).__name__}:{e}")
        if not len(src):
            return out("zero_matches")
        mine, theirs = src / scale + [c0, r0], dst / scale
        inside = (theirs >= 0).all(1) & (theirs[:, 0] < x.shape[1] - 1) & (theirs[:, 1] < x.shape[0] - 1)
        if not inside.any():
            return out("no_valid_matches_in_dense_warp")
        mine, theirs, sure = mine[inside], theirs[inside], sure[inside]
        real = np.stack([_between(a, theirs[:, 1], theirs[:, 0]) for a in (x, y)], 1)
        known = np.isfinite(real).all(1)
        if not known.any():
            return out("no_valid_U_real")
        mine, theirs, sure, real = mine[known], theirs[known], sure[known], real[known]
        if limit is not None:
            back = np.asarray(camera(np.c_[real, np.asarray(height(real), float)]), float)
            near = np.hypot(*(back - mine).T) <= limit
            mine, theirs, sure, real = mine[near], theirs[near], sure[near], real[near]
            if not len(real):
                return out("all_filtered_by_cam_consistency")
        return out("ok", np.c_[real, mine, theirs + [c0, r0], sure])

    own = lambda df: df.select(*(F.col(c).alias(c) for c in df.columns)).groupBy("tile_id")  # noqa: E731  columns of its own, as both come of the same windows
    return own(plan).cogroup(own(pixels)).applyInPandas(run, _MATCH)


def _dense(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, at_rows: np.ndarray, at_cols: np.ndarray) -> np.ndarray:
    """Bilinear values of a grid at whole pixels."""
    along = np.stack([np.interp(at_cols, cols, v) for v in values])
    return np.stack([np.interp(at_rows, rows, v) for v in along.T], 1)


def equalised(a: np.ndarray, parts: int = 8, clip: float = 2.0) -> np.ndarray:
    """Bytes with contrast-limited equalised histograms: each of ``parts`` by ``parts`` fields has its own, between whose middles values are mixed.

    No grey level counts for more than ``clip`` times the mean; what is above is dealt to all levels.
    """
    a = np.clip(np.rint(a), 0, 255).astype(np.uint8)
    ends = [np.linspace(0, n, min(parts, n) + 1).astype(int) for n in a.shape]
    tables = np.empty((len(ends[0]) - 1, len(ends[1]) - 1, 256))
    for i, (r0, r1) in enumerate(zip(ends[0], ends[0][1:])):
        for j, (c0, c1) in enumerate(zip(ends[1], ends[1][1:])):
            n = np.bincount(a[r0:r1, c0:c1].ravel(), minlength=256).astype(float)
            limit = max(1.0, clip * n.sum() / 256)
            n = np.minimum(n, limit) + np.maximum(n - limit, 0).sum() / 256
            tables[i, j] = np.cumsum(n) * 255 / n.sum()
    spots = []
    for n, e in zip(a.shape, ends, strict=True):
        at = np.interp(np.arange(n), (e[:-1] + e[1:] - 1) / 2, np.arange(len(e) - 1.0))
        low = np.minimum(at.astype(int), max(len(e) - 3, 0))
        spots.append((low, np.minimum(low + 1, len(e) - 2), at - low))
    (r, s, fr), (c, d, fc) = spots
    fr, fc = fr[:, None], fc[None, :]
    of = lambda i, j: tables[i[:, None], j[None, :], a]
    return (of(r, c) * (1 - fr) + of(s, c) * fr) * (1 - fc) + (of(r, d) * (1 - fr) + of(s, d) * fr) * fc


def corners_matcher(patch: int = 5, most: int = 8000, ratio: float = 0.75, threshold: float = 3.0, clip: float | None = 2.0) -> Matcher:
    """Corners by the smaller eigenvalue of the gradients' covariance, patches of unit variance, a ratio test and a robust homography.

    Both images are equalised first, unless ``clip`` is None.
    """

    def corners(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gy, gx = np.gradient(a)
        side = 2 * patch + 1
        box = lambda z: np.apply_along_axis(np.convolve, 0, np.apply_along_axis(np.convolve, 1, z, np.ones(5), "same"), np.ones(5), "same")
        xx, yy, xy = box(gx * gx), box(gy * gy), box(gx * gy)
        response = (xx + yy) / 2 - np.sqrt(((xx - yy) / 2) ** 2 + xy**2)
        inner = response[patch:-patch, patch:-patch] if min(a.shape) > side else np.empty((0, 0))
        if not inner.size:
            return np.empty((0, 2)), np.empty((0, side * side))
        framed = np.pad(response, 1, constant_values=-np.inf)
        peak = np.ones(response.shape, bool)
        for dr, dc in ((r, c) for r in (0, 1, 2) for c in (0, 1, 2) if (r, c) != (1, 1)):
            peak &= response >= framed[dr : dr + a.shape[0], dc : dc + a.shape[1]]
        peak &= response > 0.01 * inner.max()
        r, c = np.nonzero(peak[patch:-patch, patch:-patch])
        r, c = r + patch, c + patch
        by = np.lexsort((c, r, -response[r, c]))[:most]
        views = np.lib.stride_tricks.sliding_window_view(a, (side, side))[r[by] - patch, c[by] - patch].reshape(len(by), -1)
        views = views - views.mean(1, keepdims=True)
        return np.stack([c[by], r[by]], 1).astype(float), views / np.maximum(np.linalg.norm(views, axis=1, keepdims=True), 1e-9)

    def match(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        none = np.empty((0, 2)), np.empty((0, 2)), np.empty(0)
        (p, d), (q, e) = (corners(x if clip is None or not x.size else equalised(x, clip=clip)) for x in (a, b))
        if len(p) < 4 or len(q) < 4:
            return none
        pairs = []
        for at in range(0, len(p), 512):
            away = np.sqrt(np.maximum(2 - 2 * d[at : at + 512] @ e.T, 0))
            near = np.argpartition(away, 1, axis=1)[:, :2]
            near = np.take_along_axis(near, np.argsort(np.take_along_axis(away, near, 1), 1), 1)
            one, two = (np.take_along_axis(away, near[:, k : k + 1], 1)[:, 0] for k in (0, 1))
            good = np.flatnonzero(one < ratio * two)
            pairs += zip((good + at).tolist(), near[good, 0].tolist(), strict=True)
        if len(pairs) < 4:
            return none
        i, j = np.array(pairs).T
        found = matching.robust_homography(p[i], q[j], threshold)
        if found is None:
            return none
        keep = found[1] <= threshold
        return p[i][keep], q[j][keep], np.clip(1 - found[1][keep] / (4 * threshold + 1e-6), 0.05, 1)

    return match
