"""Ground control points: parsed lines, filters, concatenation, formatting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.functions.numeric import is_finite

FIELDS = ("point_id", "lat", "lon", "h", "sig_h1", "sig_h2", "sig_v", "image", "px_col", "px_row", "sig_c", "sig_r")
TOKENS = 11


def parse_lines(lines: DataFrame) -> DataFrame:
    """file, line_no and line with kind (header, blank, short, bad or point) and the fields of points."""
    t = F.split(F.trim("line"), r"\s+")
    rows = lines.withColumn("_t", t)
    typed = {n: F.get("_t", F.lit(k)) if n in ("point_id", "image") else F.get("_t", F.lit(k)).try_cast("double") for k, n in enumerate(FIELDS)}
    rows = rows.withColumns(typed)
    numeric = [F.col(n).isNotNull() for n in ("lat", "lon", "h", "px_col", "px_row")]
    ok = numeric[0]
    for x in numeric[1:]:
        ok = ok & x
    text = F.trim("line")
    kind = F.when(text == "", "blank").when(text.startswith("#"), "header").when(F.size("_t") < TOKENS, "short").when(~ok, "bad").otherwise("point")
    return rows.withColumn("kind", kind).drop("_t")


def filter_by_reprojection(parsed: DataFrame, predicted: DataFrame, limit: float = 50.0) -> DataFrame:
    """Parsed lines with keep: points farther than ``limit`` from, or without, a finite predicted pixel go; other lines stay.

    ``predicted``: file, line_no, samp, line_at.
    """
    rows = parsed.join(predicted, ["file", "line_no"], "left")
    off = F.hypot(F.col("samp") - F.col("px_col"), F.col("line_at") - F.col("px_row"))
    near = is_finite(F.col("samp")) & is_finite(F.col("line_at")) & F.coalesce(off <= limit, F.lit(False))
    return rows.withColumn("keep", (F.col("kind") != "point") | near)


def kept_totals(rows: DataFrame, group: str, keep: str = "keep") -> DataFrame:
    """Kept, dropped and their share per group and, with a null group, in all."""
    out = rows.rollup(group).agg(F.count_if(F.col(keep)).alias("kept"), F.count_if(~F.col(keep)).alias("dropped"), F.grouping(group).alias("is_total"))
    return out.withColumn("kept_pct", F.round(100.0 * F.col("kept") / (F.col("kept") + F.col("dropped")), 6))


def concat_lines(parsed: DataFrame) -> DataFrame:
    """One file of several: the first header, then each line of enough tokens with its number, from 0, in order of file and line.

    Numbers come from counts per file, so no task sorts all lines. Token gaps become one space. Rows: ord (file
    order, then line), out.
    """
    points = parsed.where(F.col("kind").isin("point", "bad")).select("file", "line_no", F.regexp_replace(F.trim("line"), r"\s+", " ").alias("line"))
    per = points.groupBy("file").agg(F.count("*").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    per = per.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy("line_no")
    rows = points.withColumn("_r", F.row_number().over(inside) - 1).join(per, "file")
    number = F.col("base") + F.col("_r")
    body = rows.select((number + 1).alias("ord"), F.concat(number.cast("string"), F.lit(" "), F.regexp_replace("line", r"^\S+ ", "")).alias("out"))
    head = parsed.where("kind = 'header'").agg(F.min(F.struct("file", "line_no", "line")).alias("x")).where("x is not null")
    return head.select(F.lit(0).cast("bigint").alias("ord"), F.trim("x.line").alias("out")).unionByName(body)


def format_points(points: DataFrame) -> DataFrame:
    """file and line of points with a finite height: id lat lon h sigmas image col row sigmas."""
    rows = points.where(is_finite(F.col("h")))
    line = F.format_string("%d %.15f %.15f %.6f %.3f %.3f %.3f %s %.3f %.3f %.3f %.3f", *(F.col(c) for c in ("point_id", "lat", "lon", "h", "sig_h1", "sig_h2", "sig_v", "image", "px_col", "px_row", "sig_c", "sig_r")))
    return rows.select("file", "point_id", line.alias("line"))


def residual_filter(matches: DataFrame, limit: float | None, width: int, height: int) -> DataFrame:
    """Matches with keep: a residual of at most ``limit``, if there is one, and a pixel inside the image, both ends in."""
    ok = F.col("px_col").between(0, width - 1) & F.col("px_row").between(0, height - 1)
    return matches.withColumn("keep", ok if limit is None else ok & (F.col("residual") <= limit))
