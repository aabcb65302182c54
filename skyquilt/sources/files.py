"""Readers and writers of the catalogue's file formats. All go through Spark's file sources, so any store works."""

from __future__ import annotations

import io
import json
import os
import re
import tarfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.operators.catalog import CROP, require, with_crop

ID = re.compile(r"D3C\d{4}-\d{6}[FAT]\d{3}")
#: Arrays of a match set and their types.
MATCH_SET = {"xs_ref": "double", "ys_ref": "double", "col_kh9_raw": "float", "row_kh9_raw": "float", "col_kh9_mapped": "float", "row_kh9_mapped": "float", "residual_px": "float", "confidence": "float"}
STATE = "m_positions array<double>, m_quaternions array<double>, m_nSamples bigint, m_nLines bigint, m_iTransS array<double>, m_iTransL array<double>, m_detectorSampleOrigin double, m_detectorLineOrigin double, m_intTimes array<double>, m_gsd double"


def read_catalog(spark: SparkSession, path: str, key: str = "Entity ID") -> DataFrame:
    """The frame catalogue with entity_id, corners as <corner>_lon and _lat, and nullable crop columns."""
    df = require(spark.read.parquet(path), key)
    corners = {f"{c}_{k}": F.col(f"`{c.upper()} Corne_{n}`").cast("double") for c in ("nw", "ne", "se", "sw") for k, n in (("lon", 3), ("lat", 2))}
    return with_crop(df.withColumns({"entity_id": F.col(f"`{key}`")} | corners))


def update_crops(spark: SparkSession, path: str, updates: DataFrame) -> int:
    """Sets the crop columns of every row of the updated ids and swaps the table in by renames; how many ids were found.

    The table is written beside the old one before anything is replaced; with no id found nothing is written. Between the two
    renames there is a moment without a table, in which a reader fails and can try again.
    """
    old = with_crop(spark.read.parquet(path)).drop("has_crop")
    new = updates.dropDuplicates(["entity_id"]).select(F.col("entity_id").alias("_id"), *(F.col(c).cast("bigint").alias(f"_{c}") for c in CROP))
    found = old.join(new, F.col("`Entity ID`") == F.col("_id"), "left_semi").select("`Entity ID`").distinct().count()
    if not found:
        return 0
    rows = old.join(new, F.col("`Entity ID`") == F.col("_id"), "left").withColumns({c: F.when(F.col("_id").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)) for c in CROP})
    aside, gone = (f"{path.rstrip('/')}-{k}-{uuid.uuid4().hex}" for k in ("new", "old"))
    rows.select(*old.columns).write.parquet(aside)
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    at = jvm.org.apache.hadoop.fs.Path
    if not (fs.rename(at(path), at(gone)) and fs.rename(at(aside), at(path))):
        raise OSError(f"{path} couldn't be replaced; the old table is {gone}, the new one {aside}")
    fs.delete(at(gone), True)
    return found


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 0) and line of text files, which are read whole: they are a few thousand lines."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return rows.select("file", F.posexplode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n")).alias("line_no", "line"))


def read_gcp(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no and line of control-point files, for ``gcp.parse_lines``."""
    return _numbered(spark, path)


def write_gcp(lines: DataFrame, path: str, header: str | None = None, order: str = "line_no", column: str = "line") -> None:
    """Lines in order into one file under ``path``, a header first."""
    rows = lines.select(F.col(order).cast("bigint").alias("o"), F.col(column).alias("value"))
    if header is not None:
        rows = lines.sparkSession.createDataFrame([(-1, header)], "o bigint, value string").unionByName(rows)
    rows.orderBy("o").coalesce(1).select("value").write.text(path)


def read_tsai(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, key, value and line of camera files; lines without ``=`` have no key."""
    rows = _numbered(spark, path)
    pair = F.split("line", "=", 2)
    return rows.select("file", "line_no", F.when(F.size(pair) == 2, F.trim(pair[0])).alias("key"), F.when(F.size(pair) == 2, F.trim(pair[1])).alias("value"), "line")


def read_states(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """camera_id, header (what stands before the first brace), body and the state's arrays; without a brace, an error if ``strict``."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("camera_id"), "value")
    at = F.locate("{", F.col("value"))
    none = F.raise_error(F.concat(F.lit("no camera state in "), "camera_id")).cast("string") if strict else F.lit(None).cast("string")
    rows = rows.select("camera_id", F.when(at > 0, F.expr("substring(value, 1, locate('{', value) - 1)")).alias("header"), F.when(at > 0, F.expr("substring(value, locate('{', value))")).otherwise(none).alias("body"))
    return rows.withColumn("_s", F.from_json("body", STATE)).select("camera_id", "header", "body", "_s.*")


def state_text(header: str, state: dict) -> str:
    """A camera state as it is written: its header, then JSON with sorted keys."""
    return header + json.dumps(state, indent=2, sort_keys=True) + "\n"


def read_residual_stats(spark: SparkSession, path: str) -> DataFrame:
    """image, mean, median and count; blank lines, comments, lines of fewer than four fields and those without numbers are skipped.

    A count that isn't a number is null. Without a file there is one row, of the image ``(missing)``, whose numbers are null,
    which ``cameras.residual_issues`` doesn't pass.
    """
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at):
        return spark.createDataFrame([("(missing)", None, None, None)], "image string, mean double, median double, count double")
    f = F.transform(F.split("value", ","), lambda x: F.trim(x))
    rows = spark.read.text(path).where(~F.trim("value").startswith("#") & (F.trim("value") != "")).withColumn("f", f).where(F.size("f") >= 4)
    number = lambda k: F.col("f")[k].try_cast("double")
    return rows.select(F.regexp_extract(F.col("f")[0], r"[^/]+$", 0).alias("image"), number(1).alias("mean"), number(2).alias("median"), number(3).alias("count")).where("mean is not null and median is not null")


def read_match_sets(spark: SparkSession, path: str) -> DataFrame:
    """stem and the columns of MATCH_SET of ``.npz`` files; a file without all arrays raises."""
    kind = "stem string, " + ", ".join(f"{k} {v}" for k, v in MATCH_SET.items())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, raw in zip(b["path"], b["content"], strict=True):
                with np.load(io.BytesIO(raw)) as z:
                    if missing := [k for k in MATCH_SET if k not in z]:
                        raise ValueError(f"{name} has no {', '.join(missing)}")
                    yield pd.DataFrame({"stem": os.path.basename(name).removesuffix(".npz")} | {k: z[k].astype("f8" if v == "double" else "f4") for k, v in MATCH_SET.items()})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", "content").mapInPandas(run, kind)


def write_match_sets(rows: DataFrame, path: str) -> None:
    rows.write.partitionBy("stem").parquet(path)


def write_corners(rows: DataFrame, path: str) -> None:
    """One file per entity_id under its own folder, with its lon_lat line."""
    rows.select("entity_id", F.col("lon_lat").alias("value")).repartition("entity_id").write.partitionBy("entity_id").text(path)


def list_names(spark: SparkSession, path: str) -> DataFrame:
    """name of the files and folders right under ``path``, in any store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(at)
    return spark.createDataFrame([(x.getPath().getName(),) for x in found], "name string")


def archive_members(spark: SparkSession, path: str, ending: str = ".tif") -> DataFrame:
    """archive, name and content of the members of ``.tgz`` and ``.tar.gz`` files under ``path`` whose names end so.

    An archive is one task's; nothing is extracted to a local folder, and members' folders are left out of their names.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, raw in zip(b["path"], b["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(raw), mode="r:gz") as t:
                    own = [(os.path.basename(name), os.path.basename(m.name), t.extractfile(m).read()) for m in t if m.isfile() and m.name.endswith(ending)]
                yield pd.DataFrame(own, columns=["archive", "name", "content"])

    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.{tgz,tar.gz}").load(path).select("path", "content")
    return rows.mapInPandas(run, "archive string, name string, content binary")


def write_lines_by_file(lines: DataFrame, path: str, order: str = "line_no") -> None:
    """``lines`` (file, line and ``order``) as a folder for each file with its lines in order: control points by image, or cleaned ones."""
    rows = lines.repartition("file").sortWithinPartitions("file", order).select("file", "line")
    rows.write.partitionBy("file").text(path)


def scan_ids(names: DataFrame) -> DataFrame:
    """Distinct ids that stand anywhere in ``name``, sorted."""
    return names.select(F.regexp_extract("name", ID.pattern, 0).alias("entity_id")).where("entity_id <> ''").distinct().orderBy("entity_id")


def find_pieces(ids: DataFrame, files: DataFrame) -> DataFrame:
    """entity_id, pieces and origin of each id: its folder's images, else those beside it, else its archive.

    ``files`` has path, relative to the folder that was listed. An id without any raises when it is read.
    """
    name, dir_ = F.regexp_extract("path", r"[^/]+$", 0), F.regexp_extract("path", r"^(?:(.*)/)?[^/]+$", 1)
    rows = files.select("path", name.alias("name"), dir_.alias("dir")).withColumn("entity_id", F.regexp_extract("name", f"^({ID.pattern})[_.]", 1)).where("entity_id <> ''")
    tif, inside = F.col("name").rlike(r"_[^/]*\.tif$"), F.col("dir") == F.col("entity_id")
    of = lambda c: F.sort_array(F.collect_list(F.when(c, F.col("path"))))
    found = rows.groupBy("entity_id").agg(of(tif & inside).alias("a"), of(tif & (F.col("dir") == "")).alias("b"), of(F.col("name").endswith(".tgz")).alias("c"), of(F.col("name").endswith(".tar.gz")).alias("d"))
    some = lambda c: F.size(c) > 0
    best = F.when(some("a"), F.col("a")).when(some("b"), F.col("b")).when(some("c"), F.slice("c", 1, 1)).when(some("d"), F.slice("d", 1, 1))
    origin = F.when(some("a"), "folder").when(some("b"), "flat").when(some("c") | some("d"), "archive").otherwise(F.raise_error(F.concat(F.lit("no images of "), "entity_id")).cast("string"))
    return ids.join(found, "entity_id", "left").select("entity_id", best.alias("pieces"), origin.alias("origin"))
