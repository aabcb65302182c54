"""The stages' phases as a table, what is selected of it, and what is still to do."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stage, phase, what it does, and whether an external program does it.
PHASES = (
    ("S0", "1", "config", False), ("S0", "2", "manifest", False), ("S0", "3", "footprint", False), ("S0", "4", "elevation mosaic", True), ("S0", "4b", "reference mosaic", True),
    ("S0", "5", "corner files", False), ("S0", "6", "image mosaics and crops", True), ("S0", "7", "resolved manifest", False), ("S0", "7a", "camera templates", False), ("S0", "7b", "projected elevation", True),
    ("S1", "1", "crop", True), ("S1", "2", "pyramids", True), ("S1", "3", "first cameras", True), ("S1", "4", "map projection", True), ("S1", "5", "bundle adjustment", True), ("S1", "6", "map projection", True),
    ("S1", "7", "stereo", True), ("S1", "8", "dense control points", True), ("S1", "9", "bundle adjustment", True), ("S1", "10", "map projection", True), ("S1", "11", "stereo", True), ("S1", "12", "camera rescale", False),
    ("S1", "13", "map projection", True), ("S1", "14", "map projection", True), ("S1", "15", "stereo", True),
    ("S2", "1", "linescan conversion", True), ("S2", "2", "camera rescale", False), ("S2", "3", "rotation and links", True), ("S2", "4", "map projection", True), ("S2", "5", "ties in a strip", True), ("S2", "6", "ties between strips", True),
    ("S2", "7", "tile matching", False), ("S2", "8", "joint solution", True), ("S2", "9", "map projection", True), ("S2", "10", "ties in a strip", True), ("S2", "11", "ties between strips", True), ("S2", "12", "tile matching", False),
    ("S2", "13", "joint solution", True), ("S2", "14", "joint solution", True), ("S2", "15", "camera checks", False), ("S2", "16", "map projection", True), ("S2", "17", "full resolution", True),
)


def chosen(configured: list[str] | None, variable: str) -> list[str] | None:
    """The phases that the environment's ``variable`` names, parted by spaces, else the configured ones."""
    return os.environ[variable].split() if os.environ.get(variable) else configured


def phases(spark: SparkSession, stage: str, selected: list[str] | None = None) -> DataFrame:
    """A stage's phases in order; all, or those selected."""
    rows = [(k, *x) for k, x in enumerate(PHASES) if x[0] == stage and (selected is None or x[1] in selected)]
    return spark.createDataFrame(rows, "ord int, stage string, phase string, what string, external boolean")


def still_to_do(work: DataFrame, outputs: DataFrame, excluded: DataFrame | None, key: str) -> DataFrame:
    """The work whose output doesn't exist and that isn't excluded by name."""
    out = work.join(outputs.select(key).distinct(), key, "left_anti")
    return out if excluded is None else out.join(excluded.select(key).distinct(), key, "left_anti")


def is_done(spark: SparkSession, path: str) -> bool:
    """Whether the table at ``path`` was written to its end, which Spark's mark says."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def require_inputs(spark: SparkSession, paths: dict[str, str]) -> None:
    """Raises if one of the named inputs doesn't exist."""
    at = {name: spark._jvm.org.apache.hadoop.fs.Path(path) for name, path in paths.items()}
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    if missing := [f"{name} ({paths[name]})" for name, p in at.items() if not p.getFileSystem(conf).exists(p)]:
        raise FileNotFoundError(f"no {', '.join(missing)}")


def envelope_status(text: str, max_width: int, max_height: int):
    """ok, no_envelope or oversize, from a ``width: N height: N`` in a text column."""
    w, h = (F.regexp_extract(text, rf"width: (\d+) height: (\d+)", k).try_cast("bigint") for k in (1, 2))
    return F.when(w.isNull() | h.isNull(), "no_envelope").when((w > max_width) | (h > max_height), "oversize").otherwise("ok")
