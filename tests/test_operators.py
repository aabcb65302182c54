import json
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquilt import registry
from skyquilt.functions import geodesy, numeric
from skyquilt.operators import cameras, catalog, export, footprint, gcp, matching, raster, strips, tiles
from skyquilt.operators.components import connected_components
from skyquilt.plans import phases
from skyquilt.sources import files


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_entity_ids(spark):
    ids = [("D3C1206-400556A016",), ("d3c1206-400556A016",), ("xD3C1206-400556A016",), ("D3C1206-400556T001",)]
    out = strips.with_strip(spark.createDataFrame(ids, "entity_id string"))
    assert rows(out) == [("D3C1206-400556A016", "D3C1206-400556-016", "aft"), ("D3C1206-400556T001", "D3C1206-400556-001", "transit")]


def test_strips_gate(spark):
    ids = [(x,) for x in ("D3C1206-400556A016", "D3C1206-400556F016", "D3C1206-400556F016", "D3C1206-400556T016", "D3C1206-400556F017")]
    out = strips.pivot_strips(spark.createDataFrame(ids, "entity_id string"))
    assert [tuple(r) for r in strips.incomplete(out).collect()] == [("D3C1206-400556-017",)]
    with pytest.raises(ValueError, match="400556-017"):
        strips.require_complete(out)
    assert strips.strip_rows(out.where("aft is not null")).count() == 2


def test_resolve_columns():
    assert catalog.resolve_columns(["Camera", "Camera Resolution", "ENTITY ID", "Mission"]) == {"camera": "Camera", "resolution": "Camera Resolution", "entity_id": "ENTITY ID", "mission": "Mission"}


def test_lookup_strict(spark):
    table = spark.createDataFrame([("a", 2, 1), ("a", 1, 5)], "entity_id string, o int, v int")
    ids = spark.createDataFrame([("a",), ("b",)], "entity_id string")
    assert rows(catalog.lookup(table, ids, ["o"])) == [("a", 1, 5, 2)]
    with pytest.raises(Exception, match="no catalogue row for b"):
        catalog.lookup(table, ids, ["o"], strict=True).collect()


@pytest.mark.parametrize("edges,want", [([], {}), ([(1, 1), (None, 2)], {}), ([(5, 4), (4, 3), (9, 8), (3, 5), (5, 4)], {3: 3, 4: 3, 5: 3, 8: 8, 9: 8})])
def test_components(spark, edges, want):
    assert dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect())) == want


def test_components_long_path(spark):
    path = spark.range(300).selectExpr("id * 7919 % 300 as a", "(id * 7919 + 7919) % 300 as b").where("a <> 0 and b <> 0")
    assert {r["component"] for r in connected_components(path).collect()} == {1}


def test_touching_footprints(spark):
    box = [(1, 0.0, 0.0, 1.0, 1.0), (2, 1.0, 1.0, 2.0, 2.0), (3, 1.0, 0.5, 2.0, 0.9)]
    out = footprint.footprint_components(spark.createDataFrame(box, "id long, x0 double, y0 double, x1 double, y1 double"))
    assert rows(out) == [(1, 1), (2, 2), (3, 1)]
    with pytest.raises(ValueError, match="contiguous"):
        footprint.require_contiguous(out)


@pytest.mark.parametrize(
    "one,two,meet",
    [
        ([(0, 0), (10, 10), (11, 10), (1, 0)], [(2, 0), (12, 10), (13, 10), (3, 0)], False),  # slanted strips, boxes overlap
        ([(0, 0), (10, 10), (11, 10), (1, 0)], [(0.5, 0), (10.5, 10), (13, 10), (3, 0)], True),
        ([(0, 0), (9, 9), (10, 9), (1, 0)], [(1, 0), (10, 9), (11, 9), (2, 0)], True),  # a slanted side in common
        ([(0, 0), (9, 9), (10, 9), (1, 0)], [(10, 9), (9, 10), (10, 11), (11, 10)], False),  # a corner in common
        ([(0, 0), (9, 9), (10, 9), (1, 0)], [(-0.5, -1), (10, 9), (10, 8), (0.9, -1)], True),
        ([(0, 4), (4, 0), (0, -4), (1, 0)], [(-1, 1), (0.4, 0.5), (0.4, -0.5), (-1, -1)], False),  # in the notch of the other
        ([(0, 4), (4, 0), (0, -4), (1, 0)], [(-1, 1), (1.4, 0.5), (1.4, -0.5), (-1, -1)], True),
        ([(0, 0), (0, 9), (9, 9), (9, 0)], [(4, 4), (4, 5), (5, 5), (5, 4)], True),  # inside
    ],
)
def test_slanted_footprints(spark, one, two, meet):
    names = [f"{c}_{k}" for c in ("nw", "ne", "se", "sw") for k in ("lon", "lat")]
    assert [f"{c}_lon" for c in catalog.CORNERS] == names[::2]
    for turn in range(4):
        data = [(k, *(float(v) for p in own[turn:] + own[:turn] for v in p)) for k, own in ((1, one), (2, two))]
        out = footprint.footprint_components(spark.createDataFrame(data, "id long, " + ", ".join(f"{n} double" for n in names)))
        assert rows(out) == [(1, 1), (2, 1 if meet else 2)]
    if not meet:
        with pytest.raises(ValueError, match="contiguous"):
            footprint.require_contiguous(out)


def test_upper_median(spark):
    d = spark.createDataFrame([(0, 1.0), (0, 4.0), (1, 3.0), (1, 1.0), (1, 2.0), (1, None)], "g int, x double")
    assert rows(footprint.upper_median(d, ["g"], "x", "m")) == [(0, 4.0), (1, 2.0)]


def test_tile_names_and_edges(spark):
    t = spark.createDataFrame([("n12w034.TIF",), ("S01E001.tif",), ("N12.tif",)], "name string")
    west, south = tiles.tile_corner(F.col("name"))
    assert [tuple(r) for r in t.select(west, south).collect()] == [(-34, 12), (1, -1), (None, None)]
    box = spark.createDataFrame([(1, -34.0, 13.0, -33.0, 14.0), (2, -33.5, 12.5, -33.0, 13.0)], "id long, x0 double, y0 double, x1 double, y1 double")
    assert rows(tiles.tile_overlap(t, box)) == [("n12w034.TIF", 2)]


def test_empty_grid(spark):
    e = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 5.0), (2, 0.0, 0.0, 4.0, 2.0)], "id long, x0 double, y0 double, x1 double, y1 double")
    want = [(2, k, 0, float(k), 0.0) for k in range(len(np.arange(0, 4 - 2 + 0.5, 1.0)))]
    assert rows(tiles.tile_grid(e, 2.0, 1.0)) == want


def test_opening_is_idempotent_and_drops_specks(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 9, (12, 15)).astype(float)
    cells = spark.createDataFrame([(0, r, c, float(v)) for (r, c), v in np.ndenumerate(a)], "raster_id int, row long, col long, value double")
    once = raster.opening(cells, 3).cache()
    assert rows(raster.opening(once, 3).select(*cells.columns)) == rows(once.select(*cells.columns))
    assert once.join(cells.withColumnRenamed("value", "v"), ["raster_id", "row", "col"]).where("value > v").count() == 0
    with pytest.raises(ValueError, match="odd"):
        raster.opening(cells, 4)


def test_longest_run_first_of_equal(spark):
    p = spark.createDataFrame([(0, i, v) for i, v in enumerate([0, 9, 9, 0, 9, 9])] + [(1, 0, 0)], "k int, i int, v int")
    runs = raster.longest_run(p, "k", "i", F.col("v") >= 9)
    assert rows(runs) == [(0, 1, 3)]
    with pytest.raises(Exception, match="no run in 1"):
        raster.require_run(runs, p, "k").collect()


@pytest.mark.parametrize("factor", [1, 4])
def test_crop_windows_refined_against_brute_force(spark, factor):
    rng = np.random.default_rng(9)
    a = np.where(rng.random((160, 200)) < 0.02, 90.0, 5.0)  # specks that the opening takes away
    a[42:133, 30:171] = 90.0
    a[8:20, 20:180] = 90.0
    a[42:60, :] = 90.0  # makes the outer columns no denser than the middle
    a[120:133, 30:45] = 5.0
    h, w = a.shape

    def opened(x):
        for f in (np.min, np.max):
            for axis in (0, 1):
                pad = np.pad(x, [(1, 1) if k == axis else (0, 0) for k in (0, 1)], constant_values=np.inf if f is np.min else -np.inf)
                x = f(np.stack([np.take(pad, range(k, k + x.shape[axis]), axis) for k in range(3)]), 0)
        return x

    def good(x, axis):
        return np.flatnonzero((opened(x) > 30).mean(1 - axis) >= 0.5)

    coarse = a.reshape(h // factor, factor, w // factor, factor).mean((1, 3))
    want = []
    for axis, n, m in ((0, h, w), (1, w, h)):
        run = max(np.split(i := good(coarse, axis), np.flatnonzero(np.diff(i) > 1) + 1), key=len)
        for end, at in ((0, run[0] * factor), (1, (run[-1] + 1) * factor)):
            own, rest = slice(max(0, at - 32), min(n, at + 32)), slice(int(m * 0.15), int(m * 0.85))
            i = good(a[own, rest] if axis == 0 else a[rest, own], axis)
            edge = own.start + (i[-1] + 1 if end else i[0]) if len(i) else at
            want.append(edge - 2 if end else edge + 2)
    cells = spark.createDataFrame([(0, r, c, float(v)) for (r, c), v in np.ndenumerate(a)], "raster_id int, row long, col long, value double")
    assert rows(raster.crop_windows(cells, 30.0, 0.5, 2, 3, factor=factor)) == [(0, *want)]
    assert rows(raster.crop_windows(cells, 30.0, 0.5, 2, 3, factor=factor, refine=False)) != [(0, *want)]


def test_samplers(spark):
    cells = spark.createDataFrame([(0, r, c, float("nan") if (r, c) == (2, 2) else 10.0 * r + c) for r in range(3) for c in range(3)], "raster_id int, row long, col long, value double")
    size = spark.createDataFrame([(0, 3, 3)], "raster_id int, height int, width int")
    pts = spark.createDataFrame([(1, 0, 0.5, 0.5), (2, 0, 2.0, 0.0), (3, 0, 2.1, 0.0), (4, 0, 1.5, 1.5), (5, 0, -0.5, 0.0)], "id int, raster_id int, r double, c double")
    got = {r["id"]: r["value"] for r in raster.bilinear_sample(pts, cells, size).collect()}
    assert (got[1], got[2], got[3], got[5]) == (5.5, 20.0, None, None) and math.isnan(got[4])
    assert {r["id"]: r["value"] for r in raster.bilinear_sample(pts, cells, size, half_open=True).collect()}[2] is None
    near = {r["id"]: r["value"] for r in raster.nearest_sample(pts, cells).collect()}
    assert (near[1], near[3], near[5]) == (0.0, 20.0, 0.0)
    assert raster.sample_grid(0, 10, 4) == [0, 4, 8, 9] and raster.sample_grid(3, 3, 4) == []


def test_numeric(spark):
    d = spark.createDataFrame([(2.5,), (3.5,), (float("nan"),), (None,), (float("inf"),)], "x double")
    assert [r[0] for r in d.select(numeric.is_finite(F.col("x"))).collect()] == [True, True, False, False, False]
    assert [r[0] for r in spark.createDataFrame([(2.5,), (3.5,)], "x double").select(numeric.half_even(F.col("x"))).collect()] == [2, 4]


def test_utm_round_trip(spark):
    d = spark.createDataFrame([(float(a), float(b)) for a in (-179.5, -3.1, 0.0, 74.2, 179.9) for b in (-79, -10.5, 0, 35.7, 83)], "lon double, lat double")
    zone = geodesy.utm_zone(F.col("lon"))
    e, n = geodesy.utm_forward(F.col("lon"), F.col("lat"))
    lon, lat = geodesy.utm_inverse(e, n, zone, F.col("lat") >= 0)
    x, y, z = geodesy.geodetic_to_ecef(F.col("lon"), F.col("lat"), F.lit(1234.5))
    back = geodesy.ecef_to_geodetic(x, y, z)
    for r in d.select("lon", "lat", lon, lat, *back, zone).collect():
        assert r[2] == pytest.approx(r[0], abs=1e-8) and r[3] == pytest.approx(r[1], abs=1e-8)
        assert r[4:6] == pytest.approx(r[:2], abs=1e-9) and r[6] == pytest.approx(1234.5, abs=1e-3)
    assert d.select(geodesy.utm_zone(F.lit(180.0))).first()[0] == 61


def test_homography_and_statuses(spark):
    rng = np.random.default_rng(0)
    h = np.array([[1.1, 0.1, 5], [-0.05, 0.95, 3], [1e-5, 2e-5, 1]])
    src = rng.uniform(0, 500, (60, 2))
    dst = matching.project(h, src)
    dst[::6] += 100
    p = [(1, *map(float, (*a, *b))) for a, b in zip(src, dst, strict=True)] + [(2, 0.0, 0.0, 0.0, 0.0)]
    out = matching.match_tiles(spark.createDataFrame(p, "tile_id long, x double, y double, u double, v double")).collect()
    assert sum(r["tile_id"] == 1 and r["status"] == "ok" for r in out) == 50
    assert [r["status"] for r in out if r["tile_id"] == 2] == ["zero_matches"]
    with pytest.raises(ValueError, match="matchers"):
        matching.match_tiles(spark.range(0), "none")


def test_knn_ratio_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(700, 8)).astype(np.float32)
    v[100] = v[3] + 0.01  # the nearest of a query is among the first ids
    v[400] = v[500] + 0.02  # and is a query itself
    spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    want = {}
    for q in range(0, 700, 100):
        d = ((v.astype(float) - v[q].astype(float)) ** 2).sum(1)
        d[q] = np.inf
        one, two = np.argsort(d, kind="stable")[:2]
        if np.sqrt(d[one]) < 0.95 * np.sqrt(d[two]):
            want[q] = (one, pytest.approx(d[one], abs=1e-5), pytest.approx(d[two], abs=1e-5))
    got = {r["query_id"]: (r["train_id"], r["d1"], r["d2"]) for r in registry.QUERIES["knn_ratio"](spark, str(tmp_path)).collect()}
    assert got == want and got[100][0] == 3 and got[400][0] == 500 and got[500][0] == 400


def test_camera_model_round_trip(spark):
    cam = matching.AffineCamera([[2, 0, 0.1], [0, 1.5, -0.2]], [3, 4])
    pts = spark.createDataFrame([(1.0, 2.0, 50.0), (3.0, 4.0, None)], "x double, y double, h double")
    image = matching.ground_to_image(pts, cam).collect()
    assert (image[0]["samp"], image[0]["line"]) == pytest.approx((10.0, -3.0)) and image[1]["samp"] is None
    back = matching.image_to_ground(spark.createDataFrame([(10.0, -3.0)], "samp double, line double"), cam.ray, lambda at: np.full(len(at), 50.0)).first()
    assert (back["x"], back["y"], back["h"]) == pytest.approx((1.0, 2.0, 50.0))


def test_gcp_lines(spark):
    lines = ["# one", "", "1 2 3", "7 10 20 5 1 1 1 a.tif 100 200 1 1", "8 x 20 5 1 1 1 a.tif 100 200 1 1", "9 10 20 5 1 1 1 a.tif 100 200 1", "# two"]
    parsed = gcp.parse_lines(spark.createDataFrame([("b", k, x) for k, x in enumerate(lines)] + [("a", 0, lines[3])], "file string, line_no long, line string")).cache()
    out = [r["out"] for r in gcp.concat_lines(parsed).orderBy("ord").collect()]
    assert out[0] == "# one" and [x.split()[0] for x in out[1:]] == ["0", "1", "2", "3"]
    pred = spark.createDataFrame([("b", 3, 130.0, 240.0), ("b", 5, float("nan"), 1.0), ("a", 0, 150.1, 200.0)], "file string, line_no long, samp double, line_at double")
    keep = {(r["file"], r["line_no"]): r["keep"] for r in gcp.filter_by_reprojection(parsed, pred).collect()}
    assert keep[("b", 3)] and not keep[("b", 5)] and not keep[("a", 0)] and keep[("b", 4)] and keep[("b", 1)]


def test_camera_goldens(spark, tmp_path):
    (tmp_path / "a.tsai").write_text("VERSION_4\nOPTICAL_BAR\nimage_size = 7131 1318\nimage_center = 3565.5 659\npitch = 0.000112\nf = 1.5\n")
    lines = files.read_tsai(spark, str(tmp_path))
    got = {r["key"]: r["value"] for r in cameras.scale_optical_bar(lines, 16, (114095, 21086)).collect()}
    assert (got["image_size"], got["image_center"], got["pitch"], got["f"]) == ("114095 21086", "57048.0 10544.0", "7e-06", "1.5")
    assert {r["key"]: r["value"] for r in cameras.scale_optical_bar(lines, 16).collect()}["image_size"] == "114096 21088"
    with pytest.raises(Exception, match="not an OPTICAL_BAR"):
        cameras.scale_optical_bar(lines.where("line <> 'OPTICAL_BAR'"), 2).collect()


def test_camera_checks(spark):
    ok = [1.0, 0.0, 0.0, 0.0]
    states = [("fine", [7e6, 0.0, 0.0, 7e6, 1.0, 0.0], ok * 2), ("flip", [7e6, 0.0, 0.0], ok + [-1.0, 0.0, 0.0, 0.0]), ("short", [1.0, 2.0], ok), ("turn", [1.0, 2.0, 3.0], ok + [0.0, 1.0, 0.0, 0.0]), ("low", [1.0, 2.0, 3.0], [0.4, 0.0, 0.0, 0.0])]
    out = cameras.camera_issues(cameras.camera_measures(spark.createDataFrame(states, "camera_id string, m_positions array<double>, m_quaternions array<double>")))
    assert {r["camera_id"]: r["issues"] for r in out.collect()} == {"fine": [], "flip": [], "short": ["malformed"], "turn": ["dot"], "low": ["norm_low"]}
    with pytest.raises(ValueError, match="low, short, turn"):
        cameras.require_sound(out)


def test_wkb_and_geojson(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    good = export.write_wkb(ring)
    assert export.read_wkb(good) == [[list(p) for p in ring]]
    assert [export.read_wkb(x) for x in (None, b"", good[:20], export.write_wkb(ring[:3]), export.write_wkb([(0.0, 0.0)] * 4))] == [None] * 5
    df = spark.createDataFrame([("x", None, good), ("y", 2.0, b"bad")], "`Entity ID` string, Resolution double, geometry binary")
    assert [r["value"] for r in export.geojson_rows(df).collect()] == ['{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[0.0,0.0],[1.0,0.0],[1.0,1.0],[0.0,0.0]]]},"properties":{"entity_id":"x"}}']
    assert export.map_filter() is None


def test_geojson_of_multipolygons_and_heights(spark):
    flat = export.write_wkb([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)])
    points = [(0.0, 0.0, 5.0), (1.0, 0.0, 6.0), (1.0, 1.0, 7.0), (0.0, 0.0, 5.0)]
    high = [struct.pack(f"{o}BII", int(o == "<"), code, 1) + struct.pack(f"{o}I", 4) + b"".join(struct.pack(f"{o}3d", *p) for p in points) for o in "<>" for code in (1003, 0x80000003)]
    many = struct.pack("<BII", 1, 6, 2) + flat + flat
    srid = struct.pack("<BIII", 1, 0x20000003, 4326, 1) + flat[9:]
    point = struct.pack("<BI2d", 1, 1, 0.0, 0.0)
    data = [(str(k), x) for k, x in enumerate([flat, *high, many, srid, struct.pack("<BII", 1, 6, 0), many[:50], point])]
    df = spark.createDataFrame(data, "`Entity ID` string, geometry binary")
    got = {x["properties"]["entity_id"]: (x["geometry"]["type"], x["geometry"]["coordinates"]) for x in (json.loads(r["value"]) for r in export.geojson_rows(df).collect())}
    ring, tall = [[0, 0], [1, 0], [1, 1], [0, 0]], [list(p) for p in points]
    assert got == {"0": ("Polygon", [ring]), **{str(k): ("Polygon", [tall]) for k in range(1, 5)}, "5": ("MultiPolygon", [[ring], [ring]]), "6": ("Polygon", [ring])}
    assert tuple(export.skipped_geometries(df).first()) == (10, 3)


def test_files(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/stats.csv").write_text("# c\n\n/a/b.tif, 1, 2, 3\nx,1,2\ny,nan,2,3\nz,q,2,3\n")
    got = {r["image"]: r["mean"] for r in files.read_residual_stats(spark, str(tmp_path / "s")).collect()}
    assert got["b.tif"] == 1.0 and math.isnan(got["y"]) and set(got) == {"b.tif", "y"}
    (tmp_path / "c").mkdir()
    (tmp_path / "c/cam.json").write_text('HEAD\n{"m_positions": [1, 2, 3], "m_nLines": 4}')
    r = files.read_states(spark, str(tmp_path / "c")).first()
    assert (r["header"], r["m_positions"], r["m_nLines"]) == ("HEAD\n", [1.0, 2.0, 3.0], 4)
    (tmp_path / "n").mkdir()
    np.savez(tmp_path / "n/a.npz", **{k: np.arange(3.0) for k in files.MATCH_SET})
    assert files.read_match_sets(spark, str(tmp_path / "n")).count() == 3
    names = spark.createDataFrame([("xD3C1206-400556A016_a.tif",), ("D3C1206-400556A016",), ("z",)], "name string")
    assert [r[0] for r in files.scan_ids(names).collect()] == ["D3C1206-400556A016"]
    i = "D3C1206-400556A016"
    found = files.find_pieces(spark.createDataFrame([(i,)], "entity_id string"), spark.createDataFrame([(f"{i}_b.tif",), (f"{i}_a.tif",), (f"{i}.tgz",)], "path string")).first()
    assert (found["pieces"], found["origin"]) == ([f"{i}_a.tif", f"{i}_b.tif"], "flat")


def test_update_crops(spark, tmp_path):
    at = str(tmp_path / "t")
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "`Entity ID` string, v int").write.parquet(at)
    new = spark.createDataFrame([("a", 1, 2, 3, 4)], "entity_id string, crop_xoff int, crop_yoff int, crop_xsize int, crop_ysize int")
    assert files.update_crops(spark, at, new) == 1
    assert rows(spark.read.parquet(at).select("v", "crop_xsize")) == [(1, 3), (2, 3), (3, None)]
    assert files.update_crops(spark, at, new.withColumn("entity_id", F.lit("q"))) == 0


def test_phases(spark):
    assert [phases.phases(spark, s).count() for s in ("S0", "S1", "S2")] == [10, 15, 17]
    d = spark.createDataFrame([("width: 95000 height: 30000",), ("width: 95001 height: 1",), ("",)], "t string")
    assert [r[0] for r in d.select(phases.envelope_status("t", 95000, 30000)).collect()] == ["ok", "oversize", "no_envelope"]
