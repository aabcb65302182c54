import json

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skyquilt import registry
from skyquilt.operators import footprint, matching, raster, resolve, strips, tilewarp
from skyquilt.operators.catalog import with_crop
from skyquilt.sources import config, files

CAMERA = matching.AffineCamera([[0.25, 0, 0.01], [0, -0.25, 0.0]], [10, 210])
SLOPE = lambda xy: 5 + 0.01 * xy[:, 0]


def test_windows_of_a_camera(spark):
    tiles = spark.createDataFrame([(1, 0.0, 0.0, 400.0, 400.0), (2, 5000.0, 5000.0, 5400.0, 5400.0)], "tile_id long, x0 double, y0 double, x1 double, y1 double")
    got = {r["tile_id"]: tuple(r)[1:] for r in tilewarp.raw_windows(tiles, CAMERA, SLOPE, 200, 300, 5).collect()}
    assert got == {1: (5, 105, 116, 215), 2: (None,) * 4}
    blind = tilewarp.raw_windows(tiles, CAMERA, lambda xy: np.full(len(xy), np.nan), 200, 300)
    assert {tuple(r)[1:] for r in blind.collect()} == {(None,) * 4}


def test_extent_without_ground_raises(spark):
    images = spark.createDataFrame([(1, 100, 50)], "image_id long, width long, height long")

    class Blind(matching.AffineCamera):
        def ray(self, pixel, h):
            return np.full((len(pixel), 2), np.nan)

    blind = Blind(CAMERA.matrix, CAMERA.offset)
    assert tilewarp.raw_extents(images, blind, SLOPE, strict=False).first()["x0"] is None
    with pytest.raises(PySparkException):
        tilewarp.raw_extents(images, blind, SLOPE).collect()
    assert tilewarp.round_trips(images, CAMERA, SLOPE).first()["ok"]
    with pytest.raises(PySparkException):
        tilewarp.require_round_trips(tilewarp.round_trips(images, blind, SLOPE)).collect()


def test_dense_warp_against_numpy(spark):
    windows = spark.createDataFrame([(1, 3, 2, 20, 16), (2, 0, 0, 5, 1), (3, 4, 4, 4, 9)], "tile_id long, c0 long, r0 long, c1 long, r1 long")
    nodes = tilewarp.sparse_nodes(windows, 6).withColumns({"x": F.col("samp") * F.col("line"), "y": F.col("samp") * F.col("samp")})
    got = tilewarp.dense_warp(windows, nodes, 6).toPandas()
    assert set(got["tile_id"]) == {1, 2}
    for tile, (c0, r0, c1, r1) in ((1, (3, 2, 20, 16)), (2, (0, 0, 5, 1))):
        rows, cols = (np.array(raster.sample_grid(a, b, 6), float) for a, b in ((r0, r1), (c0, c1)))
        want = tilewarp._dense(rows, cols, np.multiply.outer(rows, cols), np.arange(r0, r1), np.arange(c0, c1))
        own = got[got["tile_id"] == tile].pivot(index="row", columns="col", values="x").to_numpy()
        assert np.allclose(own, want)
    bad = nodes.withColumn("x", F.when((F.col("tile_id") == 1) & (F.col("samp") == 3), float("nan")).otherwise(F.col("x")))
    assert {r["tile_id"] for r in tilewarp.dense_warp(windows, bad, 6).collect()} == {2}


def test_dense_warp_sends_no_nodes_through_the_driver(spark):
    """Few windows are many nodes, which Spark doesn't know."""
    windows = spark.range(10).selectExpr("id as tile_id", "0L as c0", "0L as r0", "9L as c1", "9L as r1")
    nodes = tilewarp.sparse_nodes(windows, 4).selectExpr("*", "samp as x", "line as y")
    out = tilewarp.dense_warp(windows, nodes, 4)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 810


def test_reference_windows_by_hand(spark):
    rows = spark.createDataFrame([(1, 100.0, 100.0, 300.0, 200.0), (2, -5000.0, 0.0, -4000.0, 10.0)], "id long, x0 double, y0 double, x1 double, y1 double")
    got = {r["id"]: (r["col_off"], r["row_off"], r["win_w"], r["win_h"]) for r in tilewarp.reference_windows(rows, (0.0, 400.0), (3.0, -3.0), 80, 90, 20.0).collect()}
    assert got == {1: (26, 60, 54, 30), 2: (None,) * 4}


def test_area_resize_and_remap_against_numpy(spark):
    a = np.random.default_rng(3).uniform(0, 255, (11, 23))
    cells = spark.createDataFrame([(0, r, c, float(a[r, c])) for r in range(11) for c in range(23)], "raster_id long, row long, col long, value double")
    sizes = spark.createDataFrame([(0, 11, 23, 8, 9)], "raster_id long, height long, width long, new_height long, new_width long")
    got = tilewarp.area_resize(cells, sizes).toPandas().pivot(index="row", columns="col", values="value").to_numpy()
    assert np.allclose(got, tilewarp._shrink(a, 8, 9)) and np.isclose(got.mean(), a.mean())
    points = [(k, 0, float(r), float(c)) for k, (r, c) in enumerate(np.random.default_rng(4).uniform(-2, 25, (80, 2)))] + [(99, 0, float("nan"), 1.0)]
    back = {r["id"]: r["value"] for r in tilewarp.remap(spark.createDataFrame(points, "id long, raster_id long, r double, c double"), cells).collect()}
    want = tilewarp._between(a, np.array([p[2] for p in points]), np.array([p[3] for p in points]))
    assert np.allclose([back[p[0]] for p in points], want) and back[99] == 0


def scene():
    """A smooth reference of 1 m cells, and a raw image that CAMERA takes of it over SLOPE."""
    rng = np.random.default_rng(7)
    knots = rng.uniform(20, 235, (60, 60))
    y, x = np.mgrid[0:400, 0:400]
    reference = tilewarp._between(knots, y / 7.0, x / 7.0)
    r, c = np.mgrid[0:220, 0:130]
    at, _ = matching.locate(np.stack([c.ravel(), r.ravel()], 1).astype(float), CAMERA.ray, SLOPE)
    raw = tilewarp._between(reference, 400 - at[:, 1] - 0.5, at[:, 0] - 0.5).reshape(220, 130)
    return reference, raw


def cells_of(spark, a):
    r, c = np.indices(a.shape)
    return spark.createDataFrame(pd.DataFrame({"row": r.ravel(), "col": c.ravel(), "value": a.ravel()}))


def test_raw_tiles_end_to_end(spark):
    reference, raw = scene()
    tiles = spark.createDataFrame([(1, 40.0, 40.0, 360.0, 360.0), (2, 9000.0, 9000.0, 9300.0, 9300.0)], "tile_id long, x0 double, y0 double, x1 double, y1 double")
    settings = {"raw_size": (130, 220), "origin": (0.0, 400.0), "cell": (1.0, -1.0), "reference_size": (400, 400), "step": 16, "native": 4.0, "match": 4.0}
    run = lambda matcher, rawed=raw, **more: tilewarp.match_raw_tiles(tiles, cells_of(spark, rawed), cells_of(spark, reference), CAMERA, SLOPE, matcher, **settings | more).toPandas()
    got = run(tilewarp.corners_matcher(), limit=3.0)
    assert list(got[got["tile_id"] == 2]["status"]) == ["raw_bbox_invalid"]
    own = got[got["tile_id"] == 1]
    assert len(own) >= 20 and set(own["status"]) == {"ok"}
    back = CAMERA(np.c_[own[["x", "y"]], SLOPE(own[["x", "y"]].to_numpy())])
    assert np.hypot(*(back - own[["samp", "line"]].to_numpy()).T).max() <= 3 and own["confidence"].between(0.05, 1).all()

    def status(matcher, rawed=raw, **more):
        return run(matcher, rawed, **more).set_index("tile_id")["status"][1]

    nothing = lambda a, b: (np.empty((0, 2)), np.empty((0, 2)), np.empty(0))
    shifted = lambda a, b: (np.array([[40.0, 40.0]]), np.array([[60.0, 60.0]]), np.ones(1))
    outside = lambda a, b: (np.array([[1.0, 1.0]]), np.array([[-4.0, 1.0]]), np.ones(1))

    def broken(a, b):
        raise KeyError("x")

    assert status(nothing) == "zero_matches" and status(broken) == "matcher_error:KeyError:'x'" and status(outside) == "no_valid_matches_in_dense_warp"
    assert status(shifted, limit=3.0) == "all_filtered_by_cam_consistency" and status(shifted) == "ok"
    assert status(nothing, raw * 0) == "raw_crop_nodata" and status(nothing, origin=(9e5, 400.0)) == "planet_crop_empty"


def test_shrinks_by_the_resolution():
    assert tilewarp._shrink(np.arange(16.0).reshape(4, 4), 2, 2).tolist() == [[2.5, 4.5], [10.5, 12.5]]


def test_robust_homography_finds_the_majority():
    rng = np.random.default_rng(5)
    src = rng.uniform(0, 1000, (300, 2))
    h = np.array([[1.1, -0.2, 5], [0.3, 0.9, -7], [1e-5, 2e-5, 1]])
    dst = matching.project(h, src)
    dst[::3] += rng.uniform(50, 300, (100, 2))
    found, off = matching.robust_homography(src, dst, 3.0)
    good = np.ones(300, bool)
    good[::3] = False
    assert np.allclose(found, h, atol=1e-6) and (off[good] < 1e-6).all() and (off[~good] > 3).all()
    assert matching.robust_homography(src[:3], dst[:3], 3.0) is None


CORNERS = "nw_lon double, nw_lat double, ne_lon double, ne_lat double, se_lon double, se_lat double, sw_lon double, sw_lat double"


def catalogue(spark):
    box = lambda x, y: (x, y + 1, x + 2, y + 1, x + 2, y, x, y)
    rows = [("D3C1200-000001F001", 10, *box(36.0, 1.0)), ("D3C1200-000001A001", 20, *box(37.0, 2.0)), ("D3C1200-000001T001", 30, *box(48.0, -3.0)), ("D3C1200-000002F001", 40, *box(1.0, 1.0))]
    df = spark.createDataFrame(rows, "entity_id string, crop_xoff long, " + CORNERS)
    return with_crop(df.withColumns({c: F.col("crop_xoff") + k for k, c in enumerate(("crop_yoff", "crop_xsize", "crop_ysize"), 1)}))


def test_bounds_hold_transit_frames_and_zones_are_medians(spark):
    r = strips.strip_manifest(catalogue(spark)).collect()
    assert [(x["strip_id"], x["n_extras"], x["min_lon"], x["max_lon"], x["min_lat"], x["utm_zone"]) for x in r] == [("D3C1200-000001-001", 1, 36.0, 50.0, -3.0, 37)]
    with pytest.raises(PySparkException):
        strips.strip_manifest(catalogue(spark).withColumn("entity_id", F.lit("x")), strict=True).collect()


def test_region_document_round_trip(spark, tmp_path):
    own = catalogue(spark).where("entity_id like '%000001%'")
    doc = resolve.resolved_region(own, "raw", "work", "old", 0.5)
    assert doc["bbox"] == {"min_lon": 35.5, "min_lat": -3.5, "max_lon": 50.5, "max_lat": 3.5} and (doc["utm_zone"], doc["utm_hemisphere"], doc["utm_epsg"]) == (37, "N", 32637)
    assert doc["strips"][0]["fwd"]["mosaic"] == "work/inputs/mosaics/D3C1200-000001F001.tif" and doc["strips"][0]["aft"]["crop"] == {"xoff": 20, "yoff": 21, "xsize": 22, "ysize": 23}
    assert [e["entity_id"][-4:] for e in doc["strips"][0]["extras"]] == ["T001"]
    path = str(tmp_path / "region.json")
    resolve.write_region(spark, path, doc)
    text = (tmp_path / "region.json").read_text()
    assert json.loads(text) == doc and text.endswith("}\n") and '\n  "raw_dir"' in text
    row = resolve.strip_table(resolve.read_region(spark, path)).first()
    assert tuple(row) == ("D3C1200-000001-001", *(f.format(e) for e in ("D3C1200-000001F001", "D3C1200-000001A001") for f in ("{}", "work/inputs/mosaics/{}.tif", "work/inputs/cam_gen/{}.txt")), "10", "11", "12", "13", "20", "21", "22", "23", "37", "32637", "work", "4", "6")
    del doc["strips"][0]["aft"]["crop"]["yoff"]
    resolve.write_region(spark, path, doc)
    with pytest.raises(PySparkException):
        resolve.strip_table(resolve.read_region(spark, path)).collect()


def test_partners_and_paths(spark):
    files_ = spark.createDataFrame([("a/x_m4.npz",), ("/b/y_m4.npz",), ("c/y_m4.npz.bak",)], "path string")
    got = {r["path"]: (r["stem"], r["partner"], r["found"]) for r in resolve.with_partner(files_, spark.createDataFrame([("raw/x.tif",), ("raw/x.tif",)], "path string"), "_m4.npz", "raw", "", ".tif").collect()}
    assert got == {"a/x_m4.npz": ("x", "./raw/x.tif", True), "/b/y_m4.npz": ("y", "./raw/y.tif", False), "c/y_m4.npz.bak": ("y_m4.npz.bak", "./raw/y_m4.npz.bak.tif", False)}
    shown = spark.createDataFrame([("a",), ("./a",), ("../a",), ("/a",)], "p string").select(resolve.relative(F.col("p")).alias("p"))
    assert [r["p"] for r in shown.collect()] == ["./a", "./a", "../a", "/a"]


def test_templates(spark):
    text = "A\nmean_surface_elevation = 800\nx_mean_surface_elevation = 1"
    df = spark.createDataFrame([("12",), (None,)], "m string").select(resolve.substitute(F.lit(text), "mean_surface_elevation", F.col("m")).alias("t"))
    assert [r["t"] for r in df.collect()] == [text.replace("= 800", "= 12"), text]
    cells = spark.createDataFrame([(1, 2.0), (1, 3.0), (1, float("nan")), (2, 3.0), (2, 4.0)], "raster_id long, value double")
    assert {r["raster_id"]: r["mean"] for r in resolve.raster_means(cells).collect()} == {1: "2", 2: "4"}


def test_half_means_in_any_order(spark):
    """Means of 1.5 and 2.5 that come out below and above them when these values are added from left to right."""
    for values, mean in (([1.42, 2.6, 1.63, 0.35], "2"), ([3.95, 3.43, 0.12], "2")):
        for own in (values, values[::-1]):
            cells = spark.createDataFrame([(1, v) for v in own], "raster_id long, value double").coalesce(1)
            assert [r["mean"] for r in resolve.raster_means(cells).collect()] == [mean]


def test_a_template_without_values_is_null(spark, tmp_path):
    """As in the query's SQL; the operator alone leaves such a text as it is."""
    from skyquilt.registry_tiles import camera_template

    spark.createDataFrame([(1, None), (2, 3.5), (2, None)], "user_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {r["raster_id"]: r["template"] for r in camera_template(spark, str(tmp_path)).collect()}
    assert got == {1: None, 2: "OPTICAL_BAR\nmean_surface_elevation = 4\nspeed = 1"}


def test_stats_and_settings(spark, tmp_path):
    (tmp_path / "s").write_text("# h\na/b.tif, 1.5, 2, x\nc.tif, bad, 2, 3\nd.tif, 1, 2\n")
    assert [tuple(r) for r in files.read_residual_stats(spark, str(tmp_path / "s")).collect()] == [("b.tif", 1.5, 2.0, None)]
    assert [tuple(r) for r in files.read_residual_stats(spark, str(tmp_path / "none")).collect()] == [("(missing)", None, None, None)]
    (tmp_path / "c").mkdir()
    (tmp_path / "c/config.yaml").write_text("catalog: ./assets/x.parquet\nworking_dir: work\nsubdir: a\n")
    c = config.load_config(str(tmp_path / "c/config.yaml"), root=str(tmp_path))
    assert (c.catalog, c.working_dir) == (str(tmp_path / "assets/x.parquet"), str(tmp_path / "c/work"))
    (tmp_path / "c/config.yaml").write_text("catalog: x\nworking_dir: work\n")
    with pytest.raises(ValueError):
        config.load_config(str(tmp_path / "c/config.yaml"))


def test_footprint_columns(spark):
    r = catalogue(spark).select(footprint.centroid()[0].alias("x"), footprint.mean_latitude().alias("y"), footprint.polygon().alias("p")).first()
    assert (r["x"], r["y"]) == (37.0, 1.5) and len(r["p"]) == 5 and r["p"][0] == r["p"][4]


@pytest.mark.parametrize("name", ["map_filter", "crop_window", "crop_window_refined", "raw_windows", "reference_windows", "dense_warp", "area_resize", "remap", "strip_table", "region", "cells_of_windows"])
def test_queries_leave_rows(spark, name):
    assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_components_of_boxes_of_all_sizes(spark):
    r = np.random.default_rng(12)
    size = 2.0 ** r.integers(-12, 7, 150)
    x, y = r.uniform(-300, 300, (2, 150))
    boxes = [(k, float(x[k]), float(y[k]), float(x[k] + size[k]), float(y[k] + size[k] * r.uniform(0.1, 1))) for k in range(150)] + [(200, -1000.0, 0.0, 1000.0, 1.0), (201, 5.0, 0.5, 5.0, 0.5)]
    df = spark.createDataFrame(boxes, "id long, x0 double, y0 double, x1 double, y1 double")
    got = {c["node"]: c["component"] for c in footprint.footprint_components(df).collect()}
    up = {b[0]: b[0] for b in boxes}
    for a in boxes:
        for b in boxes:
            w, h = (min(a[k + 2], b[k + 2]) - max(a[k], b[k]) for k in (1, 2))
            if a[0] < b[0] and w >= 0 and h >= 0 and (w > 0 or h > 0):
                low, high = sorted((up[a[0]], up[b[0]]))
                up = {k: low if v == high else v for k, v in up.items()}
    assert got == up and len(set(up.values())) < len(up)
    assert footprint.footprint_components(df.limit(0)).count() == 0


def test_catalogue_reader_and_small_writers(spark, tmp_path):
    from skyquilt.operators import cameras, export, gcp, tiles
    from skyquilt.streaming.ingest import stream_gcp

    corners = {f"{c} Corne_{n}": float(k) for k, (c, n) in enumerate((c, n) for c in ("NW", "NE", "SE", "SW") for n in (2, 3))}
    spark.createDataFrame(pd.DataFrame([{"Entity ID": "D3C1200-000001F001", "Mission": "m"} | corners])).write.parquet(str(tmp_path / "cat"))
    row = files.read_catalog(spark, str(tmp_path / "cat")).first()
    assert (row["entity_id"], row["nw_lat"], row["nw_lon"], row["sw_lon"], row["has_crop"]) == ("D3C1200-000001F001", 0.0, 1.0, 7.0, False)
    with pytest.raises(ValueError):
        files.read_catalog(spark, str(tmp_path / "cat"), "No Such")
    states = spark.createDataFrame([("c", [1.0, 2.0], [3.0], 5.0, 7.0, [8.0], 9.0)], "camera_id string, m_iTransS array<double>, m_iTransL array<double>, m_detectorSampleOrigin double, m_detectorLineOrigin double, m_intTimes array<double>, m_gsd double")
    scaled = cameras.scale_linescan(states, F.lit(10), F.lit(20)).first()
    assert (scaled["m_iTransS"], scaled["m_iTransL"], scaled["m_detectorSampleOrigin"], scaled["m_intTimes"], scaled["m_gsd"], scaled["m_nSamples"], scaled["m_nLines"]) == ([2.0, 4.0], [6.0], 10.0, [4.0], 4.5, 10, 20)
    with pytest.raises(ValueError):
        cameras.scale_linescan(states.drop("m_gsd"), F.lit(1), F.lit(1))
    assert files.state_text("HEAD\n", {"b": 1, "a": [2]}) == 'HEAD\n{\n  "a": [\n    2\n  ],\n  "b": 1\n}\n'
    lines = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "line_no long, line string").repartition(3)
    files.write_gcp(lines, str(tmp_path / "gcp"), "# head")
    assert [p.read_text() for p in (tmp_path / "gcp").glob("part-*") if p.stat().st_size] == ["# head\na\nb\nc\n"]
    files.write_corners(spark.createDataFrame([("x", "1 2"), ("y", "3 4")], "entity_id string, lon_lat string"), str(tmp_path / "corners"))
    assert {p.parent.name: p.read_text() for p in (tmp_path / "corners").glob("*/part-*")} == {"entity_id=x": "1 2\n", "entity_id=y": "3 4\n"}
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 5.0, 5.0, 6.0, 6.0)], "id long, min_lon double, min_lat double, max_lon double, max_lat double")
    assert [r["id"] for r in export.in_view(boxes, 1.0, 1.0, 4.0, 4.0).collect()] == [1]
    names = spark.createDataFrame([(f"n{k}",) for k in range(9)], "name string")
    assert tiles.first_names(names, 3) == ["n0", "n1", "n2", "..."] and len(tiles.first_names(names, 9)) == 9
    cells = spark.createDataFrame([(0, 0, 0, 1.0), (0, 2, 1, 2.0)], "raster_id long, row long, col long, value double")
    assert sorted((r["row"], r["col"], r["value"]) for r in raster.densify(cells).collect() if r["value"]) == [(0, 0, 1.0), (2, 1, 2.0)] and raster.densify(cells).count() == 6
    profile = spark.createDataFrame([(0, k, d) for k, d in enumerate((0.1, 0.9, 0.2, 0.8, 0.1))], "raster_id long, i long, d double")
    assert tuple(raster.refine_edges(profile, "raster_id", "i", F.col("d") > 0.5).first()) == (0, 1, 4)
    manifest = strips.resolved_manifest(spark.createDataFrame([("s", "f", None, ["t"])], "strip_id string, fwd string, aft string, extras array<string>"), "raw").first()
    assert json.loads(manifest["manifest"]) == {"strip_id": "s", "fwd": {"entity_id": "f", "image": "raw/f.tif"}, "extras": ["t"]}
    (tmp_path / "stream").mkdir()
    (tmp_path / "stream/a.gcp").write_text("# WGS84\n1 2 3 4 1 1 1 a.tif 5 6 1 1\nshort\n")
    run = stream_gcp(spark, str(tmp_path / "stream")).writeStream.format("memory").queryName("arrived").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    run.awaitTermination(60)
    assert [(r["file"], r["points"]) for r in spark.table("arrived").collect()] == [("a.gcp", 1)]
    assert gcp.parse_lines(spark.createDataFrame([("f", 0, "")], "file string, line_no long, line string")).first()["kind"] == "blank"


def test_reproject_there_and_back(spark):
    box = [(0, r, c) for r in range(12) for c in range(12)]
    cells = spark.createDataFrame([(*k, float(k[1] * 100 + k[2])) for k in box], "raster_id long, row long, col long, value double")
    grid = cells.drop("value")
    here = (400_000.0, 500.0, 6_006_000.0, -500.0)
    same = raster.reproject(cells, here, 37, grid, here, 37)
    assert {(r["row"], r["col"], r["value"]) for r in same.collect()} == {(r, c, float(r * 100 + c)) for _, r, c in box}
    from skyquilt.functions import geodesy

    east, north = geodesy.utm_forward(F.lit(37.5), F.lit(54.17), F.lit(36))  # near the raster, in the zone beside its own
    at = spark.range(1).select(east.alias("e"), north.alias("n")).first()
    there = (round(at["e"]) - 20_000.0, 500.0, round(at["n"]) + 20_000.0, -500.0)
    wide = spark.range(80 * 80).selectExpr("0L as raster_id", "id div 80 as row", "id % 80 as col")
    over = raster.reproject(cells, here, 37, wide, there, 36)
    seen = {r["value"] for r in over.where("value is not null").collect()}
    assert len(seen) > 100 and over.where("value is null").count() > 5000


def test_stage_marks_inputs_and_overrides(spark, tmp_path, monkeypatch):
    from skyquilt.plans import phases

    assert not phases.is_done(spark, str(tmp_path / "t"))
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert phases.is_done(spark, str(tmp_path / "t"))
    phases.require_inputs(spark, {"table": str(tmp_path / "t")})
    with pytest.raises(FileNotFoundError, match="elevation"):
        phases.require_inputs(spark, {"table": str(tmp_path / "t"), "elevation": str(tmp_path / "none")})
    assert phases.chosen(["1"], "SKYQUILT_PHASES") == ["1"]
    monkeypatch.setenv("SKYQUILT_PHASES", "2 7a")
    own = phases.phases(spark, "S0", phases.chosen(["1"], "SKYQUILT_PHASES"))
    assert [r["phase"] for r in own.orderBy("ord").collect()] == ["2", "7a"]


def test_listing_archives_and_files_of_lines(spark, tmp_path):
    import io
    import tarfile

    with tarfile.open(tmp_path / "D3C1200-000001F001.tgz", "w:gz") as t:
        for name, data in (("x/D3C1200-000001F001_a.tif", b"abc"), ("x/read.me", b"no"), ("D3C1200-000001F001_b.tif", b"")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    (tmp_path / "D3C1200-000002A001").mkdir()
    assert sorted((r["name"], bytes(r["content"])) for r in files.archive_members(spark, str(tmp_path)).collect()) == [("D3C1200-000001F001_a.tif", b"abc"), ("D3C1200-000001F001_b.tif", b"")]
    assert [r["entity_id"] for r in files.scan_ids(files.list_names(spark, str(tmp_path))).collect()] == ["D3C1200-000001F001", "D3C1200-000002A001"]
    lines = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z")], "file string, line_no long, line string").repartition(3)
    files.write_lines_by_file(lines, str(tmp_path / "out"))
    assert {p.parent.name: p.read_text() for p in (tmp_path / "out").glob("*/part-*")} == {"file=a": "x\ny\n", "file=b": "z\n"}


def test_equalisation_keeps_order_and_limits_contrast():
    flat = tilewarp.equalised(np.full((64, 64), 100.0))
    assert np.ptp(flat) < 1e-9
    a = np.tile(np.linspace(100, 120, 64), (64, 1))
    out, hard = tilewarp.equalised(a, 1, 2.0), tilewarp.equalised(a, 1, 1e9)
    assert (np.diff(out[0]) >= -1e-9).all() and np.ptp(a) < np.ptp(out) < np.ptp(hard) <= 255
    assert tilewarp.equalised(np.zeros((3, 2))).shape == (3, 2)
