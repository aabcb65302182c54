"""Descriptor matching: two nearest neighbours and a ratio test, a robust homography, tile statuses."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyquilt.functions.numeric import confidence, inverse_confidence, is_finite

#: Why a tile is skipped, in the order in which it is asked.
SKIPS = (
    "raw_bbox_invalid", "raw_crop_nodata", "sparse_warp_nonfinite", "dense_warp_failed", "dense_warp_too_few_finite", "utm_extent_oversize",
    "planet_crop_empty", "planet_crop_oversize", "raw_crop_oversize", "warped_planet_nodata", "matcher_error", "zero_matches",
    "no_valid_matches_in_dense_warp", "no_valid_U_real", "all_filtered_by_cam_consistency",
)
DARK, FINITE, EXTENT_M, SIDE_PX = 5.0, 0.5, 50_000.0, 32_760


def two_nearest(queries: DataFrame, train: DataFrame, block: int = 256, same: bool = False) -> DataFrame:
    """query_id, train_id, d1 and d2: the nearest descriptor of ``train`` for each query and both squared distances.

    Each task compares its descriptors of ``train`` with blocks of queries and keeps two per query; ties go
    to the smaller id. Both have id and vec; if ids are of the ``same`` rows in both, a query isn't its own neighbour.
    The queries are a stated set, dealt to blocks that meet every part of ``train`` once.
    """
    parts = max(1, train.rdd.getNumPartitions())
    left = queries.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.col("id").alias("id"), F.col("vec").cast("array<double>").alias("vec"))
    right = train.select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.col("id").alias("tid"), F.col("vec").cast("array<double>").alias("tvec"))

    def compare(key, q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(t):
            t = t.sort_values("tid")
            x, ids = np.stack(t["tvec"].to_numpy()), t["tid"].to_numpy()
            for at in range(0, len(q), block):
                own = q.iloc[at : at + block]
                y = np.stack(own["vec"].to_numpy())
                d = np.stack([np.where(same & (ids == i), np.inf, ((x - v) ** 2).sum(1)) for i, v in zip(own["id"], y, strict=True)])
                best = np.argsort(d, axis=1, kind="stable")[:, :2]
                out += [(i, ids[k], v[k]) for i, v, b in zip(own["id"], d, best, strict=True) for k in b if not (same and ids[k] == i)]
        return pd.DataFrame(out, columns=["query_id", "train_id", "d"]).astype({"query_id": "int64", "train_id": "int64", "d": "float64"})

    near = left.groupBy("part").cogroup(right.groupBy("part")).applyInPandas(compare, "query_id long, train_id long, d double")
    best = near.groupBy("query_id").agg(F.min(F.struct("d", "train_id")).alias("one"))
    rest = near.join(best, "query_id").where(F.col("train_id") != F.col("one.train_id")).groupBy("query_id").agg(F.min("d").alias("d2"))
    return best.join(rest, "query_id").select("query_id", F.col("one.train_id").alias("train_id"), F.col("one.d").alias("d1"), "d2")


def ratio_test(near: DataFrame, ratio: float = 0.75) -> DataFrame:
    """Matches whose distance is below ``ratio`` of the second one's; d1 and d2 are squared."""
    return near.where(F.sqrt("d1") < ratio * F.sqrt("d2"))


def homography(src: np.ndarray, dst: np.ndarray) -> np.ndarray | None:
    """The 3 by 3 map of four points or more by least squares on normalised points; null if they don't determine one."""

    def normal(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mid = p.mean(0)
        s = np.sqrt(2) / max(np.sqrt(((p - mid) ** 2).sum(1)).mean(), 1e-12)
        t = np.array([[s, 0, -s * mid[0]], [0, s, -s * mid[1]], [0, 0, 1]])
        return (p - mid) * s, t

    (a, ta), (b, tb) = normal(src), normal(dst)
    rows = [r for (x, y), (u, v) in zip(a, b, strict=True) for r in ((x, y, 1, 0, 0, 0, -u * x, -u * y, -u), (0, 0, 0, x, y, 1, -v * x, -v * y, -v))]
    h = np.linalg.inv(tb) @ np.linalg.svd(np.array(rows))[2][-1].reshape(3, 3) @ ta
    return h / h[2, 2] if abs(h[2, 2]) > 1e-12 and np.isfinite(h).all() else None


def project(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    q = np.c_[p, np.ones(len(p))] @ h.T
    with np.errstate(all="ignore"):
        return q[:, :2] / q[:, 2:]


def _samples(n: int, tries: int, rng: np.random.Generator) -> np.ndarray:
    """``tries`` rows of four different numbers below ``n``."""
    own = rng.integers(0, n, (tries, 4))
    while len(again := np.flatnonzero((np.diff(np.sort(own, 1), axis=1) == 0).any(1))):
        own[again] = rng.integers(0, n, (len(again), 4))
    return own


def _homographies(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """The maps of many sets of four points at once, (m, 4, 2) each; what a set doesn't determine isn't finite."""

    def normal(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mid = p.mean(1, keepdims=True)
        s = np.sqrt(2) / np.maximum(np.sqrt(((p - mid) ** 2).sum(2)).mean(1), 1e-12)
        t = np.zeros((len(p), 3, 3))
        t[:, 0, 0] = t[:, 1, 1] = s
        t[:, :2, 2] = -s[:, None] * mid[:, 0]
        t[:, 2, 2] = 1
        return (p - mid) * s[:, None, None], t

    (a, ta), (b, tb) = normal(src), normal(dst)
    one, nil = np.ones(a.shape[:2]), np.zeros(a.shape[:2])
    x, y, u, v = a[..., 0], a[..., 1], b[..., 0], b[..., 1]
    rows = np.concatenate([np.stack([x, y, one, nil, nil, nil, -u * x, -u * y, -u], 2), np.stack([nil, nil, nil, x, y, one, -v * x, -v * y, -v], 2)], 1)
    h = np.linalg.inv(tb) @ np.linalg.svd(rows)[2][:, -1].reshape(-1, 3, 3) @ ta
    with np.errstate(all="ignore"):
        return np.where(np.abs(h[:, 2:, 2:]) > 1e-12, h / h[:, 2:, 2:], np.nan)


def robust_homography(src: np.ndarray, dst: np.ndarray, threshold: float, tries: int = 500, block: int = 50) -> tuple[np.ndarray, np.ndarray] | None:
    """The map that most pairs agree on within a threshold, by random sampling with a fixed seed, and each pair's residual.

    Samples are solved and scored ``block`` at a time; it ends early once a better share of agreeing pairs would have been met
    with a probability of 0.9999.
    """
    n = len(src)
    if n < 4:
        return None
    own, best, most = _samples(n, tries, np.random.default_rng(n)), None, 3
    flat = np.c_[src, np.ones(n)]
    for at in range(0, tries, block):
        part = own[at : at + block]
        maps = _homographies(src[part], dst[part])
        with np.errstate(all="ignore"):
            q = flat @ maps.transpose(0, 2, 1)
            good = np.hypot(q[..., 0] / q[..., 2] - dst[:, 0], q[..., 1] / q[..., 2] - dst[:, 1]) <= threshold
        agree = good.sum(1)
        if agree.max() > most:
            best, most = good[agree.argmax()], int(agree.max())
        if most == n or (at + block) * np.log1p(-((most / n) ** 4)) < np.log(1e-4):
            break
    if best is None:
        return None
    h = homography(src[best], dst[best])
    return None if h is None else (h, np.linalg.norm(project(h, src) - dst, axis=1))


def match_by_homography(pairs: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Rows (tile_id, x, y, u, v) of one tile to its inliers with residuals; fewer than four, or no agreement, give none."""
    src, dst = pairs[["x", "y"]].to_numpy(float), pairs[["u", "v"]].to_numpy(float)
    found = robust_homography(src, dst, threshold)
    return pairs.iloc[:0].assign(residual=0.0) if found is None else pairs.assign(residual=found[1])[found[1] <= threshold]


#: Matchers by name. A tile's matcher gets its candidate pairs and a threshold.
MATCHERS: dict[str, Callable[[pd.DataFrame, float], pd.DataFrame]] = {"homography": match_by_homography}


def match_tiles(pairs: DataFrame, matcher: str = "homography", threshold: float = 3.0, min_confidence: float | None = None) -> DataFrame:
    """tile_id, x, y, u, v, residual, confidence, inv_confidence and status of each tile's matches.

    A tile whose matcher fails has one row with the error as status and doesn't end the job; one without
    matches has one row with ``zero_matches``.
    """
    if matcher not in MATCHERS:
        raise ValueError(f"matchers are {', '.join(MATCHERS)}")
    run = MATCHERS[matcher]

    def one(own: pd.DataFrame) -> pd.DataFrame:
        try:
            out = run(own, threshold).assign(status="ok")
        except Exception as e:  # noqa: BLE001  a tile's failure is its status
            out = own.iloc[:0].assign(residual=0.0, status="")
            fault = f"matcher_error:{type(e).__name__}:{e}"
        else:
            fault = "zero_matches"
        if not len(out):
            out = pd.DataFrame({"tile_id": own["tile_id"].iloc[:1], "x": np.nan, "y": np.nan, "u": np.nan, "v": np.nan, "residual": np.nan, "status": fault})
        return out[["tile_id", "x", "y", "u", "v", "residual", "status"]]

    kind = "tile_id long, x double, y double, u double, v double, residual double, status string"
    rows = pairs.select(F.col("tile_id").cast("long").alias("tile_id"), *(F.col(c).cast("double").alias(c) for c in "xyuv")).groupBy("tile_id").applyInPandas(one, kind)
    conf = F.when(F.col("status") == "ok", confidence(F.col("residual"), threshold))
    rows = rows.withColumn("confidence", conf).withColumn("inv_confidence", inverse_confidence(F.col("confidence")))
    return rows if min_confidence is None else rows.where((F.col("status") != "ok") | (F.col("confidence") >= min_confidence))


def tile_status(m: dict[str, Column]) -> Column:
    """The first gate a tile fails, or ok. ``m`` maps each measure to a column; cheap gates come first."""
    gates = (
        ~is_finite(m["bbox"]), m["raw_mean"] < DARK, ~m["sparse_finite"], ~m["dense_ok"], m["finite_share"] < FINITE, m["extent_m"] > EXTENT_M,
        m["crop_cells"] <= 0, m["crop_side"] >= SIDE_PX, m["raw_side"] >= SIDE_PX, m["warped_mean"] < DARK, m["error"].isNotNull(), m["matches"] <= 0,
        m["in_warp"] <= 0, m["with_ground"] <= 0, m["consistent"] <= 0,
    )
    out = F.lit("ok")
    for name, gate in reversed(list(zip(SKIPS, gates, strict=True))):
        shown = F.concat(F.lit("matcher_error:"), m["error"]) if name == "matcher_error" else F.lit(name)
        out = F.when(gate, shown).otherwise(out)
    return out


def status_counts(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "status")


def ground_to_image(points: DataFrame, model: Callable[[np.ndarray], np.ndarray], columns: tuple[str, str, str] = ("x", "y", "h")) -> DataFrame:
    """Adds samp and line of ground points by a camera model on arrays; a null height, or a model that fails, gives null."""
    kind = T.StructType([*points.schema.fields, *(T.StructField(c, T.DoubleType()) for c in ("samp", "line"))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ground = b[list(columns)].to_numpy(float)
            try:
                image = np.asarray(model(ground), float)
            except Exception:  # noqa: BLE001
                image = np.full((len(b), 2), np.nan)
            image[~np.isfinite(ground).all(1)] = np.nan
            yield b.assign(samp=image[:, 0], line=image[:, 1])

    return points.mapInPandas(run, kind)


def locate(pixel: np.ndarray, ray: Callable[[np.ndarray, np.ndarray], np.ndarray], height: Callable[[np.ndarray], np.ndarray], start: float = 4000.0) -> tuple[np.ndarray, np.ndarray]:
    """Ground points and heights of pixels; see ``image_to_ground``."""
    h, live = np.full(len(pixel), start), np.ones(len(pixel), bool)
    try:
        at = np.array(ray(pixel, h), float)
        for _ in range(5):
            now = np.asarray(height(at), float)
            ok = live & np.isfinite(now)
            still = ok & (np.abs(now - h) >= 0.1)
            h[ok] = now[ok]
            if not still.any():
                break
            at[still] = np.asarray(ray(pixel[still], h[still]), float)
            live = still
    except Exception:  # noqa: BLE001
        at, h = np.full((len(pixel), 2), np.nan), np.full(len(pixel), np.nan)
    return at, h


def image_to_ground(pixels: DataFrame, ray: Callable[[np.ndarray, np.ndarray], np.ndarray], height: Callable[[np.ndarray], np.ndarray], start: float = 4000.0) -> DataFrame:
    """Adds x, y and h of pixels (samp, line): at most five turns between the ray at a height and the elevation there.

    It ends when the height moves by less than 0.1; off the elevations the last point of the ray stays; a failure gives null.
    """
    kind = T.StructType([*pixels.schema.fields, *(T.StructField(c, T.DoubleType()) for c in "xyh")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at, h = locate(b[["samp", "line"]].to_numpy(float), ray, height, start)
            yield b.assign(x=at[:, 0], y=at[:, 1], h=h)

    return pixels.mapInPandas(run, kind)


class AffineCamera:
    """A camera for tests: pixel = matrix @ (x, y, h) + offset."""

    def __init__(self, matrix, offset):
        self.matrix, self.offset = np.asarray(matrix, float), np.asarray(offset, float)

    def __call__(self, ground: np.ndarray) -> np.ndarray:
        return ground @ self.matrix.T + self.offset

    def ray(self, pixel: np.ndarray, h: np.ndarray) -> np.ndarray:
        return np.linalg.solve(self.matrix[:, :2], (pixel - self.offset - h[:, None] * self.matrix[:, 2]).T).T
