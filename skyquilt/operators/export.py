"""Export of footprints: geometry, properties, GeoJSON rows, and the map's filter."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyquilt.operators.catalog import resolve_columns

_RINGS = "array<array<array<double>>>"


def _polygon(raw: bytes, at: int) -> tuple[int, list | None, int]:
    """Of the WKB geometry at a place its kind, its rings or polygons (null if it isn't sound) and the place after it."""
    order = "<" if raw[at] == 1 else ">"
    (code,) = struct.unpack_from(f"{order}I", raw, at + 1)
    at += 5 + 4 * bool(code & 0x20000000)  # an EWKB number of a reference system
    form, kind = divmod(code & 0x0FFFFFFF, 1000)
    z, m = bool(code & 0x80000000) or form in (1, 3), bool(code & 0x40000000) or form in (2, 3)
    (n,) = struct.unpack_from(f"{order}I", raw, at)
    at, own, sound = at + 4, [], kind in (3, 6) and n > 0
    if kind == 6:
        for _ in range(n):
            inner, part, at = _polygon(raw, at)
            sound = sound and inner == 3 and part is not None
            own.append(part)
    elif kind == 3:
        size = 2 + z + m
        for _ in range(n):
            (k,) = struct.unpack_from(f"{order}I", raw, at)
            ring = np.frombuffer(raw, f"{order}f8", size * k, at + 4).reshape(k, size)[:, : 2 + z]
            at += 4 + 8 * size * k
            x, y = ring[:, 0], ring[:, 1]
            area = (x[:-1] * y[1:] - x[1:] * y[:-1]).sum()
            sound = sound and k >= 4 and bool((ring[0] == ring[-1]).all()) and bool(area) and area == area
            own.append(ring.tolist())
    return kind, own if sound else None, at


def read_geometry(raw: bytes | None) -> tuple[str, list] | None:
    """The type and the polygons of a WKB polygon or multipolygon, with heights if it has them; null for anything else.

    Null also for rings that are open or have no area; measures are left out.
    """
    try:
        kind, own, _ = _polygon(raw, 0)
    except (TypeError, IndexError, ValueError, struct.error):
        return None
    return None if own is None else ("Polygon", [own]) if kind == 3 else ("MultiPolygon", own)


def read_wkb(raw: bytes | None) -> list | None:
    """The rings of a WKB polygon; null for anything else, and for rings that are open or have no area."""
    found = read_geometry(raw)
    return found[1][0] if found and found[0] == "Polygon" else None


def write_wkb(ring: list[tuple[float, float]]) -> bytes:
    return struct.pack("<BIII", 1, 3, 1, len(ring)) + b"".join(struct.pack("<2d", *p) for p in ring)


def wkb_polygons(column: str) -> Column:
    """The type and the polygons of a column of WKB polygons and multipolygons, in Arrow batches."""

    def polygons(raw: pd.Series) -> pd.DataFrame:
        found = [read_geometry(None if x is None else bytes(x)) or (None, None) for x in raw]
        return pd.DataFrame(found, columns=["type", "polygons"])

    return F.pandas_udf(polygons, f"type string, polygons array<{_RINGS}>")(column)


def skipped_geometries(df: DataFrame) -> DataFrame:
    """rows and skipped: how many rows have a geometry that ``geojson_rows`` doesn't export."""
    return df.select(wkb_polygons("geometry").alias("_g")).agg(F.count("*").alias("rows"), F.count_if(F.col("_g.type").isNull()).alias("skipped"))


def property_value(name: str, kind: T.DataType) -> Column:
    """Null and NaN are left out, dates are ISO text, other scalars stay, anything else is text."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return c if isinstance(kind, (T.NumericType, T.StringType, T.BooleanType)) else c.cast("string")


def with_properties(df: DataFrame) -> DataFrame:
    """One column per property that a source column is found for; what the rest is called doesn't matter."""
    found = resolve_columns(df.columns)
    if "entity_id" not in found:
        raise ValueError("no column of entity ids")
    keep = ["geometry"] if "geometry" in df.columns else []
    return df.select(*keep, *(property_value(c, df.schema[c].dataType).alias(k) for k, c in found.items()))


def geojson_rows(df: DataFrame) -> DataFrame:
    """One GeoJSON feature per row with a valid polygon or multipolygon; a row's missing properties are left out.

    ``skipped_geometries`` counts the rows that are left out.
    """
    if "geometry" not in df.columns:
        raise ValueError("no column geometry")
    rows = with_properties(df)
    names = [c for c in rows.columns if c != "geometry"]
    rows = rows.withColumn("_g", wkb_polygons("geometry")).where("_g.type is not null")

    def feature(coordinates: Column) -> Column:
        shape = F.struct(F.col("_g.type").alias("type"), coordinates.alias("coordinates"))
        return F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*names).alias("properties")))

    many = F.col("_g.type") == "MultiPolygon"
    return rows.select(F.when(many, feature(F.col("_g.polygons"))).otherwise(feature(F.get("_g.polygons", F.lit(0)))).alias("value"))


def map_filter(mission: str | None = None, camera: str | None = None, since: str | None = None, until: str | None = None) -> Column | None:
    """The conjunction of the inputs that are set; none at all if none is. A row without the property fails."""
    tests = [F.col(c) == v for c, v in (("mission", mission), ("camera", camera)) if v] + [F.col("acq_date") >= since] * bool(since) + [F.col("acq_date") <= until] * bool(until)
    out = None
    for t in tests:
        out = t if out is None else out & t
    return out


def in_view(df: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Footprints (min_lon and so on) that meet a viewport."""
    return df.where((F.col("max_lon") >= x0) & (F.col("min_lon") <= x1) & (F.col("max_lat") >= y0) & (F.col("min_lat") <= y1))


def write_geojson(df: DataFrame, path: str) -> None:
    geojson_rows(df).write.text(path)


