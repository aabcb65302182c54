"""Cameras: rescaling of two kinds of model, structural and residual checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyquilt.functions.numeric import half_even, is_finite

LIMITS = {"spread": 10_000.0, "step": 2_000.0, "norm_low": 0.5, "norm_high": 2.0, "dot": 0.5, "mean": 100.0, "median": 5.0}
#: Which keys a linescan rescale by two multiplies and which it halves.
DOUBLED = ("m_iTransS", "m_iTransL", "m_detectorSampleOrigin", "m_detectorLineOrigin")
HALVED = ("m_intTimes", "m_gsd")


def scale_optical_bar(lines: DataFrame, factor: int, size: tuple[int, int] | None = None) -> DataFrame:
    """Lines (file, line_no, key, value, line) of OPTICAL_BAR cameras for an image ``factor`` times as large.

    The size is multiplied and rounded half to even, or set; the centre is multiplied, the pitch divided;
    other lines stay. A file without an OPTICAL_BAR line raises.
    """
    if factor <= 0:
        raise ValueError("the factor is above 0")
    v = F.split(F.trim("value"), r"\s+")
    plain = lambda x: F.regexp_replace(F.regexp_replace(F.lower(x.cast("string")), r"\.0e", "e"), r"e-(\d)$", "e-0$1")
    sized = F.array_join(F.transform(v, lambda x: half_even(x.cast("double") * factor).cast("string")), " ") if size is None else F.lit(f"{size[0]} {size[1]}")
    centre = F.array_join(F.transform(v, lambda x: plain(x.cast("double") * factor)), " ")
    pitch = plain(F.trim("value").cast("double") / factor)
    value = F.when(F.col("key") == "image_size", sized).when(F.col("key") == "image_center", centre).when(F.col("key") == "pitch", pitch).otherwise(F.col("value"))
    bar = lines.groupBy("file").agg(F.max(F.trim("line") == "OPTICAL_BAR").alias("_bar"))
    out = lines.join(bar, "file")
    changed = F.col("key").isin("image_size", "image_center", "pitch")
    out = out.withColumn("value", F.when(~F.col("_bar"), F.raise_error(F.concat(F.lit("not an OPTICAL_BAR camera: "), "file"))).otherwise(value))
    return out.withColumn("line", F.when(changed, F.concat_ws(" = ", "key", "value")).otherwise(F.col("line"))).drop("_bar")


def scale_linescan(states: DataFrame, samples: Column, lines: Column) -> DataFrame:
    """Linescan states for an image of twice the size: numbers, or arrays of them, doubled or halved; a missing key raises."""
    if missing := [c for c in (*DOUBLED, *HALVED) if c not in states.columns]:
        raise ValueError(f"no key {', '.join(missing)}")

    def by(name: str, f: float) -> Column:
        return F.transform(name, lambda x: x * f) if states.schema[name].dataType.typeName() == "array" else F.col(name) * f

    return states.withColumns({"m_nSamples": samples, "m_nLines": lines} | {c: by(c, 2.0) for c in DOUBLED} | {c: by(c, 0.5) for c in HALVED})


def _rows(flat: str, stride: int) -> Column:
    """The strided rows of a flat array."""
    n = F.floor(F.size(flat) / stride).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(F.col(flat), i * stride + 1, F.lit(stride)))).otherwise(F.array().cast("array<array<double>>"))


def _sum_of(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def camera_measures(states: DataFrame) -> DataFrame:
    """camera_id, spread and step of the positions, norm_low, norm_high and dot of the quaternions.

    A step of one position is 0. The dot is the least of successive, normalised ones without regard to sign;
    pairs with a zero norm don't count. Arrays whose length is no multiple give null.
    """
    ok = lambda c, k: (F.size(c) % k == 0) & (F.size(c) > 0)
    rows = states.select("camera_id", F.when(ok("m_positions", 3), _rows("m_positions", 3)).alias("p"), F.when(ok("m_quaternions", 4), _rows("m_quaternions", 4)).alias("q"))
    norm = lambda x: F.sqrt(_sum_of(x, x))
    rows = rows.select("camera_id", "p", "q", F.transform("p", norm).alias("r"), F.transform("q", norm).alias("n"))
    pair = lambda c: F.zip_with(F.slice(F.col(c), F.lit(1), F.size(c) - 1), F.slice(F.col(c), F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    steps = F.transform(pair("p"), lambda x: norm(F.zip_with(x["b"], x["a"], lambda u, v: u - v)))
    whole = F.filter(pair("q"), lambda x: (norm(x["a"]) > 0) & (norm(x["b"]) > 0))
    dots = F.transform(whole, lambda x: F.abs(_sum_of(x["a"], x["b"]) / (norm(x["a"]) * norm(x["b"]))))
    return rows.select(
        "camera_id", (F.array_max("r") - F.array_min("r")).alias("spread"), F.when(F.size("p") > 1, F.array_max(steps)).when(F.size("p") == 1, F.lit(0.0)).alias("step"),
        F.array_min("n").alias("norm_low"), F.array_max("n").alias("norm_high"), F.array_min(dots).alias("dot"),
    )


def camera_issues(measures: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Adds issues, the names of the checks a camera fails; a malformed camera has that issue alone."""
    lim = LIMITS | (limits or {})
    bad = lambda c, cond: F.when(~is_finite(F.col(c)) | cond, F.lit(c))
    checks = F.array(
        bad("spread", F.col("spread") > lim["spread"]), bad("step", F.col("step") > lim["step"]), bad("norm_low", F.col("norm_low") < lim["norm_low"]), bad("norm_high", F.col("norm_high") > lim["norm_high"]),
        F.when(F.col("dot") < lim["dot"], F.lit("dot")),
    )
    malformed = F.col("spread").isNull() | F.col("norm_low").isNull()
    return measures.withColumn("issues", F.when(malformed, F.array(F.lit("malformed"))).otherwise(F.filter(checks, lambda x: x.isNotNull())))


def residual_issues(stats: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Adds high_mean and high_median, true for a value above its limit or that isn't finite; advice only."""
    lim = LIMITS | (limits or {})
    return stats.withColumns({f"high_{c}": ~is_finite(F.col(c)) | (F.col(c) > lim[c]) for c in ("mean", "median")})


def require_sound(issues: DataFrame) -> DataFrame:
    """Raises if a camera has an issue."""
    if bad := [r["camera_id"] for r in issues.where(F.size("issues") > 0).select("camera_id").orderBy("camera_id").limit(20).collect()]:
        raise ValueError(f"unsound cameras, the first 20 at most: {', '.join(map(str, bad))}")
    return issues
