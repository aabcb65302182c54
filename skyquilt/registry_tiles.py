"""More queries of the library: per-tile geometry and the region's manifest, over the driver's tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from skyquilt.adapters import BOXES, CATALOG, adapt, grid, load
from skyquilt.functions import geodesy
from skyquilt.operators import matching, raster, resolve, tilewarp
from skyquilt.operators.catalog import CROP
from skyquilt.registry import query

CAMERA = matching.AffineCamera([[2, 0, 0.1], [0, 1.5, -0.2]], [3, 4])


def _flat(xy: np.ndarray) -> np.ndarray:
    return np.full(len(xy), 50.0)


def _slope(xy: np.ndarray) -> np.ndarray:
    return 0.02 * xy[:, 0] + 0.01 * xy[:, 1]


#: The camera on the slope, in SQL.
_SAMP, _LINE = "(2e0 * ({x}) + 0.1e0 * (0.02e0 * ({x}) + 0.01e0 * ({y})) + 3)", "(1.5e0 * ({y}) - 0.2e0 * (0.02e0 * ({x}) + 0.01e0 * ({y})) + 4)"
_IMAGES = "c_custkey AS image_id, 1000 + c_custkey % 7 * 100 AS width, 500 + c_nationkey * 10 AS height"


@query(f"""WITH i AS (SELECT {_IMAGES} FROM customer)
SELECT image_id, (0 - 8) / 2e0 AS x0, (0 + 6) / 1.5e0 AS y0, round((width - 1 - 8) / 2e0, 6) AS x1, round((height - 1 + 6) / 1.5e0, 6) AS y1, 8::BIGINT AS n_points FROM i""")
def raw_extents(spark, sf_dir):
    images = load(spark, sf_dir, "customer").selectExpr(*_IMAGES.split(", "))
    return tilewarp.raw_extents(images, CAMERA, _flat).withColumns({c: F.round(c, 6) for c in ("x0", "y0", "x1", "y1")})


@query(f"""WITH b AS (SELECT id AS tile_id, x0 * 50 AS x0, y0 * 50 AS y0, x1 * 50 AS x1, y1 * 50 AS y1 FROM ({BOXES})),
p AS (SELECT tile_id, unnest([[x0, y0], [x0, (y0 + y1) / 2], [x0, y1], [(x0 + x1) / 2, y0], [(x0 + x1) / 2, (y0 + y1) / 2], [(x0 + x1) / 2, y1], [x1, y0], [x1, (y0 + y1) / 2], [x1, y1]]) AS q FROM b),
s AS (SELECT tile_id, {_SAMP.format(x='q[1]', y='q[2]')} AS samp, {_LINE.format(x='q[1]', y='q[2]')} AS line FROM p),
w AS (SELECT tile_id, greatest(0, floor(min(samp)) - 64)::BIGINT AS c0, greatest(0, floor(min(line)) - 64)::BIGINT AS r0, least(2500, ceil(max(samp)) + 64)::BIGINT AS c1, least(1200, ceil(max(line)) + 64)::BIGINT AS r1 FROM s GROUP BY tile_id)
SELECT tile_id, CASE WHEN f THEN c0 END AS c0, CASE WHEN f THEN r0 END AS r0, CASE WHEN f THEN c1 END AS c1, CASE WHEN f THEN r1 END AS r1 FROM (SELECT *, c1 - c0 >= 32 AND r1 - r0 >= 32 AS f FROM w)""")
def raw_windows(spark, sf_dir):
    tiles = adapt(spark, sf_dir, BOXES, "supplier").selectExpr("id as tile_id", *(f"{c} * 50 as {c}" for c in ("x0", "y0", "x1", "y1")))
    return tilewarp.raw_windows(tiles, CAMERA, _slope, 2500, 1200)


@query(f"""WITH b AS (SELECT id, x0 * 1000 AS x0, y0 * 1000 AS y0, x1 * 1000 AS x1, y1 * 1000 AS y1 FROM ({BOXES})),
o AS (SELECT *, floor((x0 - 200 - 5000) / 10e0) AS c, ceil((x1 - x0 + 400) / 10e0) AS w, floor((y1 + 200 - 18000) / -10e0) AS r, ceil((y1 - y0 + 400) / 10e0) AS h FROM b),
s AS (SELECT *, greatest(0, c) AS oc, greatest(0, r) AS orow FROM o),
z AS (SELECT *, least(greatest(1, w - (oc - c)), 2000 - oc) AS zw, least(greatest(1, h - (orow - r)), 1500 - orow) AS zh FROM s)
SELECT id, x0, y0, x1, y1, CASE WHEN zw >= 4 AND zh >= 4 THEN oc::BIGINT END AS col_off, CASE WHEN zw >= 4 AND zh >= 4 THEN orow::BIGINT END AS row_off,
  CASE WHEN zw >= 4 AND zh >= 4 THEN zw::BIGINT END AS win_w, CASE WHEN zw >= 4 AND zh >= 4 THEN zh::BIGINT END AS win_h FROM z""")
def reference_windows(spark, sf_dir):
    extents = adapt(spark, sf_dir, BOXES, "supplier").selectExpr("id", *(f"{c} * 1000 as {c}" for c in ("x0", "y0", "x1", "y1")))
    return tilewarp.reference_windows(extents, (5000.0, 18000.0), (10.0, -10.0), 2000, 1500)


_WINDOWS = "p_partkey AS tile_id, p_partkey % 50 AS c0, p_partkey % 31 AS r0, p_partkey % 50 + 5 + p_size % 9 AS c1, p_partkey % 31 + 4 + p_size % 6 AS r1"
_NODE = "({s} * {s} / 100e0 + {l})", "({s} / 2e0 - {l} * {l} / 50e0)"


def _dense_oracle() -> str:
    ends = "{k}0 + (least({v}, {k}1 - 2) - {k}0) // 4 * 4 AS {v}a, least({k}0 + (least({v}, {k}1 - 2) - {k}0) // 4 * 4 + 4, {k}1 - 1) AS {v}b"
    mixed = lambda f: " + ".join(f"{f.format(s=s, l=q)} * {w}" for s, q, w in (("ca", "ra", "(1 - fr) * (1 - fc)"), ("cb", "ra", "(1 - fr) * fc"), ("ca", "rb", "fr * (1 - fc)"), ("cb", "rb", "fr * fc")))
    return f"""WITH w AS (SELECT {_WINDOWS} FROM part), a AS (SELECT *, unnest(range(r0, r1)) AS r FROM w), b AS (SELECT *, unnest(range(c0, c1)) AS c FROM a),
e AS (SELECT *, {ends.format(k='r', v='r')}, {ends.format(k='c', v='c')} FROM b), f AS (SELECT *, (r - ra)::DOUBLE / (rb - ra) AS fr, (c - ca)::DOUBLE / (cb - ca) AS fc FROM e)
SELECT tile_id, r AS "row", c AS col, round({mixed(_NODE[0])}, 6) AS x, round({mixed(_NODE[1])}, 6) AS y FROM f"""


@query(_dense_oracle())
def dense_warp(spark, sf_dir):
    windows = load(spark, sf_dir, "part").selectExpr(*_WINDOWS.split(", "))
    nodes = tilewarp.sparse_nodes(windows, 4)
    nodes = nodes.selectExpr("*", *(f"{v.format(s='samp', l='line')} as {n}" for n, v in zip("xy", _NODE, strict=True)))
    return tilewarp.dense_warp(windows, nodes, 4).withColumns({c: F.round(c, 6) for c in "xy"})


_SPOTS = "o_orderkey AS id, 0 AS raster_id, CASE WHEN o_orderkey % 50 = 0 THEN cast('NaN' AS double) ELSE (o_custkey % 1600) / 10e0 - 1 END AS r, {first} + (o_orderkey % 330) / 10e0 - 1 AS c"


@query(f"""WITH g AS ({grid('duckdb')}), f AS (SELECT min(col) AS first FROM g), p AS (SELECT {_SPOTS.format(first='first')} FROM orders, f),
q AS (SELECT *, floor(r) AS r0, floor(c) AS c0, r - floor(r) AS fr, c - floor(c) AS fc FROM p WHERE NOT isnan(r)),
n AS (SELECT id, unnest([{{'y': r0, 'x': c0, 'w': (1 - fr) * (1 - fc)}}, {{'y': r0, 'x': c0 + 1, 'w': (1 - fr) * fc}}, {{'y': r0 + 1, 'x': c0, 'w': fr * (1 - fc)}}, {{'y': r0 + 1, 'x': c0 + 1, 'w': fr * fc}}]) AS n FROM q),
s AS (SELECT id, sum(value * n.w) AS v FROM n JOIN g ON g."row" = n.y::BIGINT AND g.col = n.x::BIGINT GROUP BY id)
SELECT p.id, raster_id, CASE WHEN isnan(r) THEN -9 ELSE r END AS r, c, round(coalesce(v, 0), 6) AS value FROM p LEFT JOIN s ON s.id = p.id""")
def remap(spark, sf_dir):
    cells = adapt(spark, sf_dir, grid("spark"), "events")
    first = cells.agg(F.min("col").alias("first"))
    points = load(spark, sf_dir, "orders").join(F.broadcast(first)).selectExpr(*_SPOTS.format(first="first").split(", "))
    return tilewarp.remap(points, cells).withColumns({"value": F.round("value", 6), "r": F.when(F.isnan("r"), -9).otherwise(F.col("r"))})


_ZERO = "SELECT raster_id, row - (SELECT min(row) FROM g) AS row, col - (SELECT min(col) FROM g) AS col, value FROM g"


@query(f"""WITH g AS ({grid('duckdb')}), z AS ({_ZERO.replace('row', '"row"')}), s AS (SELECT max("row") + 1 AS h, max(col) + 1 AS w FROM z),
n AS (SELECT *, greatest(8, round_even(h * 0.4e0, 0))::BIGINT AS nh, greatest(8, round_even(w * 0.4e0, 0))::BIGINT AS nw FROM s),
c AS (SELECT raster_id, value, "row" * nh / h::DOUBLE AS ra, ("row" + 1) * nh / h::DOUBLE AS rb, col * nw / w::DOUBLE AS ca, (col + 1) * nw / w::DOUBLE AS cb, nh, nw FROM z, n),
o AS (SELECT raster_id, value, y, x, least(rb, y + 1) - greatest(ra, y) AS wr, least(cb, x + 1) - greatest(ca, x) AS wc FROM c, (SELECT unnest(range(100000)) AS y) a, (SELECT unnest(range(1000)) AS x) b
      WHERE y < nh AND x < nw AND y < rb AND y + 1 > ra AND x < cb AND x + 1 > ca)
SELECT raster_id, y AS "row", x AS col, round(sum(value * wr * wc) / sum(wr * wc), 6) AS value FROM o WHERE wr > 1e-9 AND wc > 1e-9 GROUP BY raster_id, y, x""")
def area_resize(spark, sf_dir):
    cells = adapt(spark, sf_dir, grid("spark"), "events")
    low = F.broadcast(cells.agg(F.min("row").alias("r"), F.min("col").alias("c")))
    cells = cells.join(low).select("raster_id", (F.col("row") - F.col("r")).alias("row"), (F.col("col") - F.col("c")).alias("col"), "value")
    sizes = cells.groupBy("raster_id").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    sizes = sizes.withColumns({"new_height": tilewarp.shrunken(F.col("height"), 0.4), "new_width": tilewarp.shrunken(F.col("width"), 0.4)})
    return tilewarp.area_resize(cells, sizes).withColumn("value", F.round("value", 6))


_X, _Y = "(o_custkey % 100)", "(o_orderkey % 70)"
_GROUND = f"o_orderkey AS id, cast({_X} AS double) AS x, cast({_Y} AS double) AS y"


@query(f"""WITH p AS (SELECT {_GROUND}, o_orderkey % 9 - 4 AS d, o_custkey % 5 AS e FROM orders)
SELECT id, x, y, round({_SAMP.format(x='x', y='y')} + d, 6) AS samp, round({_LINE.format(x='x', y='y')} + e, 6) AS line FROM p WHERE d * d + e * e <= 9""")
def consistent_matches(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").selectExpr(*_GROUND.split(", ")[:1], f"cast({_X} as double) as x", f"cast({_Y} as double) as y", "o_orderkey % 9 - 4 as d", "o_custkey % 5 as e")
    rows = rows.selectExpr("id", "x", "y", f"{_SAMP.format(x='x', y='y').replace('e0', 'D')} + d as samp", f"{_LINE.format(x='x', y='y').replace('e0', 'D')} + e as line")
    return tilewarp.consistent(rows, CAMERA, _slope, 3.0 + 1e-9).withColumns({c: F.round(c, 6) for c in ("samp", "line")})


@query("SELECT c_custkey AS image_id, 0.0e0 AS error, true AS ok FROM customer")
def round_trips(spark, sf_dir):
    images = load(spark, sf_dir, "customer").selectExpr(*_IMAGES.split(", "))
    return tilewarp.round_trips(images, CAMERA, _flat).withColumn("error", F.round("error", 6))


@query("SELECT l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS r FROM lineitem) WHERE r <= 40")
def strongest_keypoints(spark, sf_dir):
    return tilewarp.strongest(load(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", ["l_orderkey", "l_linenumber"], 40).select("l_suppkey", "l_extendedprice")


@query("SELECT o_orderkey, o_custkey % 3 AS kept, sum(o_custkey % 3) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM orders")
def running_kept(spark, sf_dir):
    return tilewarp.running_kept(load(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey % 3 as kept"), "o_orderkey", "kept")


@query("""SELECT 'out/s' || p_partkey || '_m4.npz' AS path, 's' || p_partkey AS stem, CASE WHEN p_partkey % 2 = 0 THEN './' ELSE '' END || CASE WHEN p_partkey % 2 = 0 THEN 'raw' ELSE '/raw' END || '/s' || p_partkey || '_sub4.tif' AS partner, p_size < 40 AS found FROM part""")
def match_set_images(spark, sf_dir):
    part, out = load(spark, sf_dir, "part"), None
    listed = part.where("p_size < 40").selectExpr("concat(if(p_partkey % 2 = 0, 'raw', '/raw'), '/s', p_partkey, '_sub4.tif') as path")
    for k, folder in enumerate(("raw", "/raw")):
        own = resolve.with_partner(part.where(f"p_partkey % 2 = {k}").selectExpr("concat('out/s', p_partkey, '_m4.npz') as path"), listed, "_m4.npz", folder, "", "_sub4.tif")
        out = own if out is None else out.unionByName(own)
    return out


@query("SELECT 'gcp/a' || s_suppkey || '.gcp' AS path, 'a' || s_suppkey AS stem, '../cams/run-a' || s_suppkey || '_sub4.json' AS partner FROM supplier WHERE s_suppkey % 4 <> 1")
def control_point_cameras(spark, sf_dir):
    supplier = load(spark, sf_dir, "supplier")
    listed = supplier.where("s_suppkey % 4 <> 1").selectExpr("concat('../cams/run-a', s_suppkey, '_sub4.json') as path")
    files = supplier.selectExpr("concat('gcp/a', s_suppkey, '.gcp') as path")
    return resolve.with_partner(files, listed, ".gcp", "../cams", "run-", "_sub4.json").where("found").drop("found")


_CROPS = "l_partkey AS crop_xoff, l_partkey % 7 AS crop_yoff, 100 + l_partkey % 5 AS crop_xsize, 200 + l_partkey % 3 AS crop_ysize"
_OWN_CROPS = CATALOG.replace("CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_linenumber * 100 END AS crop_xoff", _CROPS)


@query(f"""WITH c AS ({_OWN_CROPS}), p AS (SELECT DISTINCT regexp_extract(entity_id, '^(D3C[0-9]{{4}}-[0-9]{{6}})[FAT]([0-9]{{3}})$', 1) || '-' || right(entity_id, 3) AS strip_id, substr(entity_id, 15, 1) AS k, entity_id, crop_xoff AS a, crop_yoff AS b, crop_xsize AS d, crop_ysize AS e FROM c),
f AS (SELECT * FROM p WHERE k = 'F'), g AS (SELECT * FROM p WHERE k = 'A')
SELECT strip_id, f.entity_id AS fwd_id, 'work/inputs/mosaics/' || f.entity_id || '.tif' AS fwd_mosaic, 'work/inputs/cam_gen/' || f.entity_id || '.txt' AS fwd_corners,
  g.entity_id AS aft_id, 'work/inputs/mosaics/' || g.entity_id || '.tif' AS aft_mosaic, 'work/inputs/cam_gen/' || g.entity_id || '.txt' AS aft_corners,
  f.a::VARCHAR AS fwd_xoff, f.b::VARCHAR AS fwd_yoff, f.d::VARCHAR AS fwd_xsize, f.e::VARCHAR AS fwd_ysize, g.a::VARCHAR AS aft_xoff, g.b::VARCHAR AS aft_yoff, g.d::VARCHAR AS aft_xsize, g.e::VARCHAR AS aft_ysize,
  '37' AS utm_zone, '32637' AS utm_epsg, 'work' AS working_dir, '4' AS threads, '6' AS jobs FROM f JOIN g USING (strip_id)""")
def strip_table(spark, sf_dir):
    records = resolve.strip_records(adapt(spark, sf_dir, _OWN_CROPS, "lineitem"), "raw", "work")
    settings = F.struct(F.lit(6).alias("match_jobs"), F.lit(4).alias("threads_per_job"))
    return resolve.strip_table(records.withColumns({"utm_zone": F.lit(37), "utm_epsg": F.lit(32637), "working_dir": F.lit("work"), "compute": settings}))


def centroid_sql(k: str) -> str:
    """The area-weighted centroid of the corners' quadrilateral."""
    ring, turn = ("nw", "ne", "se", "sw", "nw"), "({a}_lon * {b}_lat - {b}_lon * {a}_lat)"
    turns = [turn.format(a=a, b=b) for a, b in zip(ring, ring[1:], strict=False)]
    return f"({' + '.join(f'({a}_{k} + {b}_{k}) * {t}' for a, b, t in zip(ring, ring[1:], turns, strict=False))}) / (3 * ({' + '.join(turns)}))"


@query(f"""WITH c AS ({CATALOG}), p AS (SELECT *, {centroid_sql('lon')} AS x, {centroid_sql('lat')} AS y FROM c),
m AS (SELECT list_sort(list(x))[count(*) // 2 + 1] AS median_lon, list_sort(list(y))[count(*) // 2 + 1] AS median_lat, min(least(nw_lon, ne_lon, se_lon, sw_lon)) - 0.01e0 AS min_lon, min(least(nw_lat, ne_lat, se_lat, sw_lat)) - 0.01e0 AS min_lat,
  max(greatest(nw_lon, ne_lon, se_lon, sw_lon)) + 0.01e0 AS max_lon, max(greatest(nw_lat, ne_lat, se_lat, sw_lat)) + 0.01e0 AS max_lat FROM p)
SELECT min_lon, min_lat, max_lon, max_lat, round(median_lon, 6) AS median_lon, round(median_lat, 6) AS median_lat, (floor((median_lon + 180) / 6) + 1)::INTEGER AS utm_zone, CASE WHEN median_lat >= 0 THEN 'N' ELSE 'S' END AS utm_hemisphere,
  (CASE WHEN median_lat >= 0 THEN 32600 ELSE 32700 END + floor((median_lon + 180) / 6) + 1)::INTEGER AS utm_epsg FROM m""")
def region(spark, sf_dir):
    out = resolve.region(adapt(spark, sf_dir, CATALOG, "lineitem"), 0.01)
    return out.withColumns({c: F.round(c, 6) for c in ("median_lon", "median_lat")})


def _bounds_oracle() -> str:
    k = 2 * geodesy.N**0.5 / (1 + geodesy.N)
    radius = geodesy.SCALE * geodesy.RECTIFYING
    series = lambda first, f, g: " + ".join([first, *(f"{a!r} * {f}({2 * j} * xi) * {g}({2 * j} * eta)" for j, a in enumerate(geodesy.ALPHA, 1))])
    return f"""WITH b AS ({BOXES}), s AS (SELECT *, unnest(range(23)) / 22e0 AS f FROM b),
p AS (SELECT id, unnest([[x0 + (x1 - x0) * f, y0], [x0 + (x1 - x0) * f, y1], [x0, y0 + (y1 - y0) * f], [x1, y0 + (y1 - y0) * f]]) AS q FROM s),
t AS (SELECT id, radians(q[1] - (3 * 6 - 183)) AS l, sinh(atanh(sin(radians(q[2]))) - {k!r} * atanh({k!r} * sin(radians(q[2])))) AS t FROM (SELECT id, [q[1] - 168, q[2]] AS q FROM p)),
u AS (SELECT id, atan2(t, cos(l)) AS xi, atanh(sin(l) / sqrt(1 + t * t)) AS eta FROM t)
SELECT id, round(min({geodesy.EAST0!r} + {radius!r} * ({series('eta', 'cos', 'sinh')})), 3) AS x0, round(min({radius!r} * ({series('xi', 'sin', 'cosh')})), 3) AS y0,
  round(max({geodesy.EAST0!r} + {radius!r} * ({series('eta', 'cos', 'sinh')})), 3) AS x1, round(max({radius!r} * ({series('xi', 'sin', 'cosh')})), 3) AS y1 FROM u GROUP BY id"""


@query(_bounds_oracle())
def bounds_to_utm(spark, sf_dir):
    boxes = adapt(spark, sf_dir, BOXES, "supplier").selectExpr("id", "x0 - 168 as x0", "y0", "x1 - 168 as x1", "y1")
    return resolve.bounds_to_utm(boxes, 3).withColumns({c: F.round(c, 3) for c in ("x0", "y0", "x1", "y1")})


@query("""SELECT user_id AS raster_id, 'OPTICAL_BAR' || chr(10) || 'mean_surface_elevation = ' || round_even(avg(value), 0)::BIGINT || chr(10) || 'speed = 1' AS template FROM events GROUP BY user_id""")
def camera_template(spark, sf_dir):
    cells = load(spark, sf_dir, "events").select(F.col("user_id").alias("raster_id"), "value")
    text = F.lit("OPTICAL_BAR\nmean_surface_elevation = 800\nspeed = 1")
    filled = resolve.substitute(text, "mean_surface_elevation", F.col("mean"))
    return resolve.raster_means(cells).select("raster_id", F.when(F.col("mean").isNotNull(), filled).alias("template"))


@query("""SELECT 'a/run-' || n_name || '_' || t || '_sub4.adjusted_state.json' AS source, 'b/' || n_name || '_' || t || '_sub4.json' AS target FROM nation, (VALUES ('fwd'), ('aft')) v(t)
WHERE n_nationkey % 3 <> 0 AND NOT (t = 'fwd' AND n_nationkey % 5 = 1)""")
def clean_links(spark, sf_dir):
    nation = load(spark, sf_dir, "nation")
    have = nation.where("n_nationkey % 3 <> 0").selectExpr("explode(array(concat('a/run-', n_name, '_fwd_sub4.adjusted_state.json'), concat('a/run-', n_name, '_aft_sub4.adjusted_state.json'))) as path")
    done = nation.where("n_nationkey % 5 = 1").selectExpr("concat('b/', n_name, '_fwd_sub4.json') as path")
    return resolve.clean_links(nation.selectExpr("n_name as strip_id"), "a", "b", have.union(done))


@query("SELECT 'raw/' || p_partkey || '.tif' AS path, 'raw/' || p_partkey || '.tif 100 50' AS line FROM part")
def uncertainty_lines(spark, sf_dir):
    return resolve.uncertainty_lines(load(spark, sf_dir, "part").selectExpr("concat('raw/', p_partkey, '.tif') as path"), 100, 50)


@query("SELECT p_partkey FROM part WHERE p_size % 4 = 0")
def crops_to_find(spark, sf_dir):
    crops = {c: F.when(F.col("p_size") % 4 != 0, F.col("p_size").cast("bigint")) for c in CROP}
    from skyquilt.operators.catalog import with_crop

    return resolve.crops_to_find(with_crop(load(spark, sf_dir, "part").withColumns(crops)), True).select("p_partkey")


@query("""SELECT c_custkey, c_nationkey::VARCHAR AS jobs, (c_custkey % 9)::VARCHAR AS second FROM customer""")
def json_values(spark, sf_dir):
    doc = F.to_json(F.struct(F.struct(F.col("c_nationkey").alias("match_jobs")).alias("compute"), F.array(F.lit(1), F.col("c_custkey") % 9).alias("size")))
    rows = load(spark, sf_dir, "customer").select("c_custkey", doc.alias("doc"))
    return rows.select("c_custkey", resolve.json_value(F.col("doc"), "$.compute.match_jobs").alias("jobs"), resolve.json_value(F.col("doc"), "$.size[1]").alias("second"))


@query(f"""WITH g AS ({grid('duckdb')}), w AS (SELECT user_id AS tile_id, user_id % 9 * 10 AS r0, user_id % 9 * 10 + 7 AS r1, (SELECT min(col) FROM g) + user_id % 5 AS c0, (SELECT min(col) FROM g) + user_id % 5 + 6 AS c1 FROM (SELECT DISTINCT user_id FROM events))
SELECT tile_id, "row", col, value FROM w JOIN g ON g."row" >= r0 AND g."row" < r1 AND g.col >= c0 AND g.col < c1""")
def cells_of_windows(spark, sf_dir):
    cells = adapt(spark, sf_dir, grid("spark"), "events")
    first = F.broadcast(cells.agg(F.min("col").alias("first")))
    windows = load(spark, sf_dir, "events").select("user_id").distinct().join(first).selectExpr("user_id as tile_id", "user_id % 9 * 10 as r0", "user_id % 9 * 10 + 7 as r1", "first + user_id % 5 as c0", "first + user_id % 5 + 6 as c1")
    return tilewarp.cells_of_windows(windows, cells, 0)


@query(f"""WITH g AS ({grid('duckdb')}) SELECT raster_id, "row", col, value FROM g WHERE "row" BETWEEN 5 AND 44""")
def window_read(spark, sf_dir):
    return raster.window(adapt(spark, sf_dir, grid("spark"), "events"), 5, 0, 40, 1 << 30)
