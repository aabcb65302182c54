"""The library's queries: name to callable over the driver's tables, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.adapters import BOXES, CATALOG, MATCHES, adapt, grid, load
from skyquilt.functions import geodesy
from skyquilt.functions.numeric import confidence, inverse_confidence
from skyquilt.operators import cameras, catalog, export, footprint, gcp, matching, raster, strips, tiles
from skyquilt.plans import phases

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return put


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt(spark, sf_dir, CATALOG, "lineitem")


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt(spark, sf_dir, grid("spark"), "events")


_IN_CATALOG = f"WITH c AS ({CATALOG}), p AS (SELECT *, regexp_extract(entity_id, '^(D3C[0-9]{{4}}-[0-9]{{6}})[FAT]([0-9]{{3}})$', 1) || '-' || right(entity_id, 3) AS strip_id, substr(entity_id, 15, 1) AS k FROM c)"
_IN_GRID = f"WITH g AS ({grid('duckdb')})"


_RING = ("nw", "ne", "se", "sw", "nw")
_TURNS = [f"({a}_lon * {b}_lat - {b}_lon * {a}_lat)" for a, b in zip(_RING, _RING[1:], strict=False)]
#: The longitude of the area-weighted centroid of the corners' quadrilateral.
_CENTROID = f"({' + '.join(f'({a}_lon + {b}_lon) * {t}' for a, b, t in zip(_RING, _RING[1:], _TURNS, strict=False))}) / (3 * ({' + '.join(_TURNS)}))"


@query(f"""{_IN_CATALOG}, x AS (SELECT *, {_CENTROID} AS x FROM p)
SELECT strip_id, max(entity_id) FILTER (k = 'F') AS fwd, max(entity_id) FILTER (k = 'A') AS aft, count(*) FILTER (k = 'T') AS n_extras,
  min(least(nw_lon, ne_lon, se_lon, sw_lon)) AS min_lon, min(least(nw_lat, ne_lat, se_lat, sw_lat)) AS min_lat,
  max(greatest(nw_lon, ne_lon, se_lon, sw_lon)) AS max_lon, max(greatest(nw_lat, ne_lat, se_lat, sw_lat)) AS max_lat,
  cast(floor((list_sort(list(x))[count(*) // 2 + 1] + 180) / 6) + 1 AS integer) AS utm_zone
FROM x GROUP BY strip_id HAVING fwd IS NOT NULL AND aft IS NOT NULL""")
def strip_manifest(spark, sf_dir):
    return strips.strip_manifest(_catalog(spark, sf_dir))


_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


@query(f"""WITH c AS ({CATALOG}), f AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY {', '.join(_ORDER)}) AS r, count(*) OVER (PARTITION BY entity_id) AS n_rows FROM c)
SELECT entity_id, n_rows, sw_lon, sw_lat, crop_xoff FROM f WHERE r = 1 AND entity_id IN (
  SELECT concat('D3C', cast(1200 + o_orderkey % 20 AS string), '-', lpad(cast(o_custkey % 2000 AS string), 6, '0'), 'F', lpad(cast(o_orderkey % 5 AS string), 3, '0')) FROM orders)""")
def catalog_lookup_first(spark, sf_dir):
    ids = load(spark, sf_dir, "orders").selectExpr("concat('D3C', cast(1200 + o_orderkey % 20 AS string), '-', lpad(cast(o_custkey % 2000 AS string), 6, '0'), 'F', lpad(cast(o_orderkey % 5 AS string), 3, '0')) AS entity_id")
    return catalog.lookup(_catalog(spark, sf_dir), ids, _ORDER).select("entity_id", "n_rows", "sw_lon", "sw_lat", "crop_xoff")


_BOX_CORNERS = "x0 AS nw_lon, y1 AS nw_lat, x1 AS ne_lon, y1 AS ne_lat, x1 AS se_lon, y0 AS se_lat, x0 AS sw_lon, y0 AS sw_lat"


@query(f"""WITH b AS ({BOXES}), c AS (SELECT id, {_BOX_CORNERS} FROM b)
SELECT id, printf('%.6f %.6f %.6f %.6f %.6f %.6f %.6f %.6f', nw_lon, nw_lat, ne_lon, ne_lat, se_lon, se_lat, sw_lon, sw_lat) AS lon_lat,
       printf('%.6f %.6f %.6f %.6f %.6f %.6f %.6f %.6f', se_lon, se_lat, sw_lon, sw_lat, nw_lon, nw_lat, ne_lon, ne_lat) AS lon_lat_rotated FROM c""")
def corner_strings(spark, sf_dir):
    c = adapt(spark, sf_dir, BOXES, "supplier").selectExpr("id", *_BOX_CORNERS.split(", "))
    return c.select("id", catalog.corner_string().alias("lon_lat"), catalog.corner_string(True).alias("lon_lat_rotated"))


@query("SELECT c_nationkey, list_sort(list(c_acctbal))[count(*) // 2 + 1] AS median FROM customer GROUP BY c_nationkey")
def upper_median_by_group(spark, sf_dir):
    return footprint.upper_median(load(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal", "median")


@query("""SELECT o_orderkey, o_orderstatus AS mission, o_orderpriority AS camera, strftime(o_orderdate, '%Y-%m-%d') AS acq_date FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate >= timestamp '1996-01-01 00:00:00' AND o_orderdate < timestamp '1999-01-01 00:00:00'""")
def map_filter(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("mission"), F.col("o_orderpriority").alias("camera"), F.to_date("o_orderdate").alias("acq_date"))
    shown = export.map_filter(mission="F", since="1996-01-01", until="1998-12-31")
    return rows.where(shown).withColumn("acq_date", F.date_format("acq_date", "yyyy-MM-dd"))


@query("""SELECT cast(p_partkey AS string) AS entity_id, p_brand AS mission, CASE WHEN p_size % 7 <> 0 THEN p_retailprice END AS resolution,
  CASE WHEN p_size % 5 <> 0 THEN strftime(date '1970-01-01' + cast(p_size AS integer), '%Y-%m-%d') END AS acq_date FROM part""")
def geojson_properties(spark, sf_dir):
    rows = load(spark, sf_dir, "part").selectExpr("cast(p_partkey as string) as `Entity ID`", "p_brand as Mission", "case when p_size % 7 <> 0 then p_retailprice else double('NaN') end as `Resolution (m)`", "case when p_size % 5 <> 0 then date_add(date'1970-01-01', p_size) end as `Acquisition Date`", "p_name as other")
    return export.with_properties(rows)


@query("""WITH p AS (SELECT p_partkey AS k, p_brand AS b, p_partkey % 90 AS x FROM part)
SELECT '{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[' || x || '.0,0.0],[' || x + 1 || '.0,0.0],[' || x + 1 || '.0,1.0],[' || x || '.0,0.0]]]},"properties":{"entity_id":"' || k || '","mission":"' || b || '"}}' AS value
FROM p WHERE k % 10 > 1""")
def geojson_rows(spark, sf_dir):
    """Triangles, of which a fifth are missing or cut off."""

    def geometry(keys):
        ring = lambda k: [(k % 90, 0.0), (k % 90 + 1.0, 0.0), (k % 90 + 1.0, 1.0), (k % 90, 0.0)]
        return keys.map(lambda k: None if k % 10 == 0 else export.write_wkb(ring(k))[: 8 if k % 10 == 1 else None])

    wkb = F.pandas_udf(geometry, "binary")
    return export.geojson_rows(load(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("Entity ID"), F.col("p_brand").alias("Mission"), wkb("p_partkey").alias("geometry")))


@query(f"""WITH b AS ({BOXES}), n AS (SELECT DISTINCT printf('N%02dE%03d.tif', p_partkey % 22, p_partkey * 7 % 36) AS name, p_partkey * 7 % 36 AS x, p_partkey % 22 AS y FROM part)
SELECT name, id FROM n JOIN b ON x < x1 AND x + 1 > x0 AND y < y1 AND y + 1 > y0""")
def tile_overlap(spark, sf_dir):
    names = load(spark, sf_dir, "part").select(F.format_string("N%02dE%03d.tif", F.expr("p_partkey % 22"), F.expr("p_partkey * 7 % 36")).alias("name"))
    return tiles.tile_overlap(names, adapt(spark, sf_dir, BOXES, "supplier"))


@query("SELECT a, b FROM (SELECT n_name AS a, lead(n_name) OVER (ORDER BY n_nationkey * 7919 % 50, n_name) AS b FROM nation) WHERE b IS NOT NULL")
def adjacent_pairs(spark, sf_dir):
    return footprint.adjacent_pairs(load(spark, sf_dir, "nation").select("n_name", F.expr("n_nationkey * 7919 % 50").alias("lat")), "n_name", "lat")


@query(f"""WITH b AS ({BOXES}), n AS (SELECT *, cast(greatest(0, ceil((x1 - 2.0e0 + 0.5e0 - x0) / 1.0e0)) AS bigint) AS nx, cast(greatest(0, ceil((y1 - 2.0e0 + 0.5e0 - y0) / 1.0e0)) AS bigint) AS ny FROM b),
x AS (SELECT *, unnest(range(nx)) AS ix FROM n), y AS (SELECT *, unnest(range(ny)) AS iy FROM x)
SELECT id, ix, iy, x0 + ix * 1.0e0 AS x0, y0 + iy * 1.0e0 AS y0 FROM y""")
def tile_grid(spark, sf_dir):
    return tiles.tile_grid(adapt(spark, sf_dir, BOXES, "supplier"), 2.0, 1.0)


@query(f"""WITH RECURSIVE b AS ({BOXES}),
e AS (SELECT a.id AS x, b.id AS y FROM b a JOIN b ON a.id <> b.id AND least(a.x1, b.x1) >= greatest(a.x0, b.x0) AND least(a.y1, b.y1) >= greatest(a.y0, b.y0)
      AND (least(a.x1, b.x1) > greatest(a.x0, b.x0) OR least(a.y1, b.y1) > greatest(a.y0, b.y0))),
r AS (SELECT id AS x, id AS y FROM b UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT x AS node, min(y) AS component FROM r GROUP BY x""")
def footprint_components(spark, sf_dir):
    return footprint.footprint_components(adapt(spark, sf_dir, BOXES, "supplier"))


@query("""WITH i AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
g AS (SELECT user_id, i, i - row_number() OVER (PARTITION BY user_id ORDER BY i) AS k FROM i WHERE value >= 50),
r AS (SELECT user_id, min(i) AS start, max(i) + 1 AS stop FROM g GROUP BY user_id, k)
SELECT user_id, start, stop FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY stop - start DESC, start) AS n FROM r) WHERE n = 1""")
def longest_run(spark, sf_dir):
    w = raster.Window.partitionBy("user_id").orderBy("ts", "event_id")
    profile = load(spark, sf_dir, "events").select("user_id", F.row_number().over(w).alias("i"), "value")
    return raster.longest_run(profile, "user_id", "i", F.col("value") >= 50)


def _opened(axes: str) -> str:
    text, last = _IN_GRID, "g"
    for f in ("min", "max"):
        for axis in axes.split():
            other = "col" if axis == "row" else "row"
            text += f', {f}_{axis} AS (SELECT raster_id, "row", col, {f}(value) OVER (PARTITION BY {other} ORDER BY {axis} RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS value FROM {last})'
            last = f"{f}_{axis}"
    return f"{text} SELECT * FROM {last}"


@query(_opened("col"))
def opening_1d(spark, sf_dir):
    return raster.opening(_grid(spark, sf_dir), 3, ("col",)).select("raster_id", "row", "col", "value")


@query(_opened("row col"))
def opening_2d(spark, sf_dir):
    return raster.opening(_grid(spark, sf_dir), 3).select("raster_id", "row", "col", "value")


@query(f'{_IN_GRID} SELECT raster_id, "row", avg(CASE WHEN value > 300 THEN 1 ELSE 0 END) AS density FROM g GROUP BY raster_id, "row"')
def density_profile(spark, sf_dir):
    return raster.density(_grid(spark, sf_dir), "row", 300.0)


def _runs(axis: str) -> str:
    return f"""d_{axis} AS (SELECT {axis} AS i, avg(CASE WHEN value > 30 THEN 1.0e0 ELSE 0 END) AS d FROM g GROUP BY {axis}),
r_{axis} AS (SELECT min(i) AS a, max(i) + 1 AS b FROM (SELECT i, i - row_number() OVER (ORDER BY i) AS k FROM d_{axis} WHERE d >= 0.5) GROUP BY k ORDER BY b - a DESC, a LIMIT 1),
e_{axis} AS (SELECT greatest(a + 1, 0) AS lo, least(b - 1, hi) AS hi FROM r_{axis}, (SELECT min(i) AS l, max(i) + 1 AS hi FROM d_{axis}) WHERE b - a >= 0.5 * (hi - l))"""


@query(f"{_IN_GRID}, {_runs('row')}, {_runs('col')} SELECT 0 AS raster_id, e_row.lo AS row0, e_row.hi AS row1, e_col.lo AS col0, e_col.hi AS col1 FROM e_row, e_col WHERE e_row.lo < e_row.hi AND e_col.lo < e_col.hi")
def crop_window(spark, sf_dir):
    return raster.crop_windows(_grid(spark, sf_dir), 30.0, 0.5, 1, 1, refine=False)


@query()
def crop_window_refined(spark, sf_dir):
    return raster.crop_windows(_grid(spark, sf_dir), 5.0, 0.5, 1, 3)


@query(f"""{_IN_GRID}, p AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM g)
SELECT raster_id, "row", col, cast(floor(least(greatest((value - lo) / greatest(hi - lo, 1.0e0), 0), 1) * 255) AS integer) AS byte FROM g, p""")
def percentile_stretch(spark, sf_dir):
    return raster.percentile_stretch(_grid(spark, sf_dir))


@query(f'{_IN_GRID} SELECT raster_id, "row" // 2 AS "row", col // 2 AS col, round(avg(value), 6) AS value FROM g GROUP BY 1, 2, 3')
def block_average(spark, sf_dir):
    return raster.block_average(_grid(spark, sf_dir), 2).withColumn("value", F.round("value", 6))


_POINTS = "o_orderkey AS id, 0 AS raster_id, (o_custkey % 1600) / 10e0 AS r, {first} + (o_orderkey % 330) / 10e0 AS c"


def _points(spark, sf_dir, cells):
    first = cells.agg(F.min("col").alias("first"))
    return load(spark, sf_dir, "orders").join(F.broadcast(first)).selectExpr(*_POINTS.format(first="first").split(", "))


@query(f"""{_IN_GRID}, f AS (SELECT min(col) AS first FROM g), p AS (SELECT {_POINTS.format(first='first')} FROM orders, f)
SELECT id, p.raster_id, r, c, value FROM p LEFT JOIN g ON g."row" = cast(floor(r) AS bigint) AND g.col = cast(floor(c) AS bigint)""")
def nearest_sample(spark, sf_dir):
    cells = _grid(spark, sf_dir)
    return raster.nearest_sample(_points(spark, sf_dir, cells), cells)


@query(f"""{_IN_GRID}, f AS (SELECT min(col) AS first, max("row") + 1 AS h, max(col) + 1 AS w FROM g), p AS (SELECT {_POINTS.format(first='first')}, h, w FROM orders, f),
q AS (SELECT id, floor(r)::BIGINT AS r0, least(floor(r) + 1, h - 1)::BIGINT AS r1, floor(c)::BIGINT AS c0, least(floor(c) + 1, w - 1)::BIGINT AS c1, r - floor(r) AS fr, c - floor(c) AS fc FROM p WHERE r >= 0 AND c >= 0 AND r <= h - 1 AND c <= w - 1),
s AS (SELECT id, a.value * ((1 - fr) * (1 - fc)) + b.value * ((1 - fr) * fc) + d.value * (fr * (1 - fc)) + e.value * (fr * fc) AS v FROM q
  JOIN g a ON a."row" = r0 AND a.col = c0 JOIN g b ON b."row" = r0 AND b.col = c1 JOIN g d ON d."row" = r1 AND d.col = c0 JOIN g e ON e."row" = r1 AND e.col = c1)
SELECT p.id, raster_id, r, c, round(v, 6) AS value FROM p LEFT JOIN s ON s.id = p.id""")
def bilinear_sample(spark, sf_dir):
    cells = _grid(spark, sf_dir)
    size = cells.groupBy("raster_id").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    return raster.bilinear_sample(_points(spark, sf_dir, cells), cells, size).withColumn("value", F.round("value", 6))


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
d AS (SELECT a.vec_id AS query_id, b.vec_id AS train_id, list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), train_id) AS k, lead(d) OVER (PARTITION BY query_id ORDER BY round(d, 9), train_id) AS d2 FROM d)
SELECT query_id, train_id, round(d, 6) AS d1, round(d2, 6) AS d2 FROM r WHERE k = 1 AND sqrt(d) < 0.95 * sqrt(d2)""")
def knn_ratio(spark, sf_dir):
    """The stated search set, a share of the table, against every other row."""
    e = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    near = matching.ratio_test(matching.two_nearest(e.where("id % 100 = 0"), e, same=True), 0.95)
    return near.withColumns({c: F.round(c, 6) for c in ("d1", "d2")})


_NORM = "sqrt(list_sum(list_transform({}, lambda x: x * x)))"


@query(f"""WITH e AS (SELECT vec_id AS camera_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
p AS (SELECT camera_id, unnest(range(21)) AS i, v FROM e), q AS (SELECT camera_id, unnest(range(16)) AS i, v FROM e),
ps AS (SELECT camera_id, i, v[3 * i + 1:3 * i + 3] AS a, lead(v[3 * i + 1:3 * i + 3]) OVER (PARTITION BY camera_id ORDER BY i) AS b FROM p),
qs AS (SELECT camera_id, i, v[4 * i + 1:4 * i + 4] AS a, lead(v[4 * i + 1:4 * i + 4]) OVER (PARTITION BY camera_id ORDER BY i) AS b FROM q),
pm AS (SELECT camera_id, max({_NORM.format('a')}) - min({_NORM.format('a')}) AS spread, max(CASE WHEN b IS NOT NULL THEN sqrt((b[1]-a[1])*(b[1]-a[1]) + (b[2]-a[2])*(b[2]-a[2]) + (b[3]-a[3])*(b[3]-a[3])) END) AS step FROM ps GROUP BY camera_id),
qm AS (SELECT camera_id, min({_NORM.format('a')}) AS norm_low, max({_NORM.format('a')}) AS norm_high,
  min(CASE WHEN b IS NOT NULL THEN abs((a[1]*b[1] + a[2]*b[2] + a[3]*b[3] + a[4]*b[4]) / ({_NORM.format('a')} * {_NORM.format('b')})) END) AS dot FROM qs GROUP BY camera_id)
SELECT camera_id, round(spread, 6) AS spread, round(step, 6) AS step, round(norm_low, 6) AS norm_low, round(norm_high, 6) AS norm_high, round(dot, 6) AS dot,
  concat_ws(',', CASE WHEN spread > 0.5 THEN 'spread' END, CASE WHEN step > 0.8 THEN 'step' END, CASE WHEN norm_low < 0.1 THEN 'norm_low' END, CASE WHEN norm_high > 2 THEN 'norm_high' END, CASE WHEN dot < 0.01 THEN 'dot' END) AS issues
FROM pm JOIN qm USING (camera_id)""")
def camera_qc(spark, sf_dir):
    states = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("camera_id"), F.col("embedding").cast("array<double>").alias("m_quaternions")).withColumn("m_positions", F.slice("m_quaternions", 1, 63))
    out = cameras.camera_issues(cameras.camera_measures(states), {"spread": 0.5, "step": 0.8, "norm_low": 0.1, "dot": 0.01})
    return out.withColumns({c: F.round(c, 6) for c in ("spread", "step", "norm_low", "norm_high", "dot")}).withColumn("issues", F.array_join("issues", ","))


@query("""SELECT l_suppkey AS image, round(avg(l_quantity), 6) AS mean, round(quantile_cont(l_quantity, 0.5), 6) AS median, count(*) AS n,
  avg(l_quantity) > 25.5e0 AS high_mean, quantile_cont(l_quantity, 0.5) > 25.25e0 AS high_median FROM lineitem GROUP BY l_suppkey""")
def residual_qc(spark, sf_dir):
    stats = load(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("image")).agg(F.avg("l_quantity").alias("mean"), F.percentile("l_quantity", 0.5).alias("median"), F.count("*").alias("n"))
    out = cameras.residual_issues(stats, {"mean": 25.5, "median": 25.25})
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "median")})


@query(f"""WITH m AS ({MATCHES}), k AS (SELECT image, px_col BETWEEN 0 AND 399 AND px_row BETWEEN 0 AND 399 AND residual <= 6 AS keep FROM m)
SELECT image, count(*) FILTER (keep) AS kept, count(*) FILTER (NOT keep) AS dropped, cast(grouping(image) AS tinyint) AS is_total, round(100.0e0 * count(*) FILTER (keep) / count(*), 6) AS kept_pct FROM k GROUP BY ROLLUP (image)""")
def residual_filter_rollup(spark, sf_dir):
    return gcp.kept_totals(gcp.residual_filter(adapt(spark, sf_dir, MATCHES, "lineitem"), 6.0, 400, 400), "image")


@query(f"""WITH m AS ({MATCHES}) SELECT l_orderkey, l_linenumber, l_partkey, round(least(greatest(1 - residual / (4 * 3.0e0 + 1e-6), 0.05e0), 1), 9) AS confidence,
  round(1 / greatest(least(greatest(1 - residual / (4 * 3.0e0 + 1e-6), 0.05e0), 1), 1e-6), 9) AS inv_confidence FROM m""")
def match_confidence(spark, sf_dir):
    conf = confidence(F.col("residual"), 3.0)
    return adapt(spark, sf_dir, MATCHES, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(conf, 9).alias("confidence"), F.round(inverse_confidence(conf), 9).alias("inv_confidence"))


_LINES = """SELECT cast(o_custkey % 13 AS string) AS file, o_orderkey AS line_no, CASE o_orderkey % 11 WHEN 0 THEN '# WGS84' WHEN 1 THEN '' WHEN 2 THEN '1 2 3'
  ELSE concat(cast(o_orderkey AS string), '  ', cast(o_custkey % 90 AS string), ' ', CASE WHEN o_orderkey % 17 = 3 THEN 'x' ELSE cast(o_custkey % 180 AS string) END, ' 100 1 1 1 a.tif   ', cast(o_orderkey % 700 AS string), ' ', cast(o_orderkey % 500 AS string), ' 1 1') END AS line FROM orders"""


@query(f"""WITH l AS ({_LINES}), p AS (SELECT *, row_number() OVER (ORDER BY file, line_no) - 1 AS n, regexp_replace(trim(line), '\\s+', ' ', 'g') AS t FROM l WHERE line NOT LIKE '#%' AND line <> '' AND line <> '1 2 3')
SELECT 0 AS ord, '# WGS84' AS out FROM (SELECT 1 FROM l WHERE line LIKE '#%' LIMIT 1) UNION ALL SELECT n + 1, cast(n AS string) || ' ' || regexp_replace(t, '^\\S+ ', '') FROM p""")
def gcp_concat(spark, sf_dir):
    return gcp.concat_lines(gcp.parse_lines(adapt(spark, sf_dir, _LINES, "orders")))


@query(f"""WITH l AS ({_LINES}), t AS (SELECT *, string_split(regexp_replace(trim(line), '\\s+', ' ', 'g'), ' ') AS a FROM l),
k AS (SELECT file, line_no, CASE WHEN len(a) < 11 THEN true WHEN try_cast(a[3] AS DOUBLE) IS NULL THEN true
  ELSE sqrt((line_no % 650 - try_cast(a[9] AS DOUBLE)) ^ 2 + (line_no % 480 - try_cast(a[10] AS DOUBLE)) ^ 2) <= 50 END AS keep FROM t)
SELECT file, count(*) FILTER (keep) AS kept, count(*) FILTER (NOT keep) AS dropped, cast(grouping(file) AS tinyint) AS is_total, round(100.0e0 * count(*) FILTER (keep) / count(*), 6) AS kept_pct FROM k GROUP BY ROLLUP (file)""")
def gcp_reprojection_filter(spark, sf_dir):
    parsed = gcp.parse_lines(adapt(spark, sf_dir, _LINES, "orders"))
    predicted = parsed.where("kind = 'point'").selectExpr("file", "line_no", "cast(line_no % 650 as double) as samp", "cast(line_no % 480 as double) as line_at")
    return gcp.kept_totals(gcp.filter_by_reprojection(parsed, predicted), "file")


@query("""SELECT 'f' AS file, o_orderkey AS point_id, printf('%d %.15f %.15f %.6f %.3f %.3f %.3f %s %.3f %.3f %.3f %.3f', o_orderkey, (o_custkey % 64)::DOUBLE / 4, (o_custkey % 128)::DOUBLE / 8, (o_orderkey % 4096)::DOUBLE / 2, 5.0::DOUBLE, 5.0::DOUBLE, 10.0::DOUBLE,
  o_orderstatus || '.tif', (o_orderkey % 800)::DOUBLE / 4, (o_orderkey % 600)::DOUBLE / 4, 1.0::DOUBLE, 1.0::DOUBLE) AS line FROM orders WHERE o_orderkey % 9 <> 0""")
def gcp_lines(spark, sf_dir):
    d = "cast({} as double)".format
    one, five, ten = (f"double({x})" for x in (1, 5, 10))
    rows = load(spark, sf_dir, "orders").selectExpr(
        "'f' as file", "o_orderkey as point_id", f"{d('o_custkey % 64')} / 4 as lat", f"{d('o_custkey % 128')} / 8 as lon", f"case when o_orderkey % 9 = 0 then double('NaN') else {d('o_orderkey % 4096')} / 2 end as h",
        f"{five} as sig_h1", f"{five} as sig_h2", f"{ten} as sig_v", "concat(o_orderstatus, '.tif') as image", f"{d('o_orderkey % 800')} / 4 as px_col", f"{d('o_orderkey % 600')} / 4 as px_row", f"{one} as sig_c", f"{one} as sig_r",
    )
    return gcp.format_points(rows)


@query("""WITH s AS (SELECT CASE WHEN doc_id % 23 = 0 THEN 'raw_bbox_invalid' WHEN n_chars < 60 THEN 'raw_crop_nodata' WHEN doc_id % 19 = 0 THEN 'sparse_warp_nonfinite' WHEN n_chars % 100 < 20 THEN 'dense_warp_too_few_finite'
  WHEN n_chars > 9000 THEN 'utm_extent_oversize' WHEN doc_id % 13 = 0 THEN 'matcher_error:E:' || lang WHEN n_chars % 11 = 0 THEN 'zero_matches' WHEN n_chars % 7 = 0 THEN 'all_filtered_by_cam_consistency' ELSE 'ok' END AS status FROM documents)
SELECT status, count(*) AS n FROM s GROUP BY status""")
def tile_status_hist(spark, sf_dir):
    n, d, yes, one = F.col("n_chars"), F.col("doc_id"), F.lit(True), F.lit(1)
    m = {
        "bbox": F.when(d % 23 == 0, F.lit(float("nan"))).otherwise(1.0), "raw_mean": F.when(n < 60, 4.0).otherwise(5.0), "sparse_finite": d % 19 != 0, "dense_ok": yes, "finite_share": F.when(n % 100 < 20, 0.49).otherwise(0.5),
        "extent_m": F.when(n > 9000, 50_000.5).otherwise(50_000.0), "crop_cells": one, "crop_side": one, "raw_side": one, "warped_mean": F.lit(5.0), "error": F.when(d % 13 == 0, F.concat(F.lit("E:"), "lang")),
        "matches": n % 11, "in_warp": one, "with_ground": one, "consistent": n % 7,
    }
    return matching.status_counts(load(spark, sf_dir, "documents").select(matching.tile_status(m).alias("status")))


@query("""WITH t AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN url ELSE 'size width: ' || cast(length(html) * 20 AS string) || ' height: ' || cast(length(url) * 700 AS string) END AS t FROM pages),
w AS (SELECT page_id, try_cast(regexp_extract(t, 'width: (\\d+) height: (\\d+)', 1) AS bigint) AS w, try_cast(regexp_extract(t, 'width: (\\d+) height: (\\d+)', 2) AS bigint) AS h FROM t)
SELECT page_id, CASE WHEN w IS NULL OR h IS NULL THEN 'no_envelope' WHEN w > 95000 OR h > 30000 THEN 'oversize' ELSE 'ok' END AS status FROM w""")
def envelope_gate(spark, sf_dir):
    t = "case when page_id % 5 = 0 then url else concat('size width: ', cast(length(html) * 20 as string), ' height: ', cast(length(url) * 700 as string)) end as t"
    return load(spark, sf_dir, "pages").selectExpr("page_id", t).select("page_id", phases.envelope_status("t", 95_000, 30_000).alias("status"))


@query("""SELECT cast(p_partkey AS string) AS file, 2 AS line_no, 'image_size = ' || cast(p_size * 16 AS string) || ' ' || cast((p_size + 3) * 16 AS string) AS line FROM part
UNION ALL SELECT cast(p_partkey AS string), 1, 'OPTICAL_BAR' FROM part UNION ALL SELECT cast(p_partkey AS string), 3, 'speed = ' || cast(p_size AS string) FROM part""")
def camera_rescale(spark, sf_dir):
    row = "named_struct('line_no', {}, 'key', {}, 'value', {}, 'line', {})".format
    none = "cast(null as string)"
    kinds = f"""inline(array({row(1, none, none, "'OPTICAL_BAR'")}, {row(2, "'image_size'", "concat(p_size, ' ', p_size + 3)", "''")}, {row(3, "'speed'", "cast(p_size as string)", "concat('speed = ', p_size)")}))"""
    return cameras.scale_optical_bar(load(spark, sf_dir, "part").selectExpr("cast(p_partkey as string) as file", kinds), 16).select("file", "line_no", "line")


_LONLAT = "s_suppkey AS id, -179e0 + (s_suppkey * 7919 % 3500) / 10e0 AS lon, -80e0 + (s_suppkey * 104729 % 1600) / 10e0 AS lat, s_acctbal AS h"


@query(f"""WITH p AS (SELECT {_LONLAT} FROM supplier), v AS (SELECT *, {geodesy.A!r} / sqrt(1 - {geodesy.E2!r} * sin(radians(lat)) * sin(radians(lat))) AS v FROM p)
SELECT id, round((v + h) * cos(radians(lat)) * cos(radians(lon)), 3) AS x, round((v + h) * cos(radians(lat)) * sin(radians(lon)), 3) AS y, round((v * {1 - geodesy.E2!r} + h) * sin(radians(lat)), 3) AS z FROM v""")
def geodetic_to_ecef(spark, sf_dir):
    p = load(spark, sf_dir, "supplier").selectExpr(*_LONLAT.split(", "))
    x, y, z = geodesy.geodetic_to_ecef(F.col("lon"), F.col("lat"), F.col("h"))
    return p.select("id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"), F.round(z, 3).alias("z"))


def _utm_oracle() -> str:
    k = 2 * geodesy.N**0.5 / (1 + geodesy.N)
    radius = geodesy.SCALE * geodesy.RECTIFYING
    east = " + ".join(["eta", *(f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geodesy.ALPHA, 1))])
    north = " + ".join(["xi", *(f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geodesy.ALPHA, 1))])
    return f"""WITH p AS (SELECT {_LONLAT} FROM supplier), z AS (SELECT *, cast(floor((lon + 180) / 6) + 1 AS integer) AS zone FROM p),
t AS (SELECT *, radians(lon - (zone * 6 - 183)) AS l, sinh(atanh(sin(radians(lat))) - {k!r} * atanh({k!r} * sin(radians(lat)))) AS t FROM z),
u AS (SELECT *, atan2(t, cos(l)) AS xi, atanh(sin(l) / sqrt(1 + t * t)) AS eta FROM t)
SELECT id, zone, CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + zone AS epsg, round({geodesy.EAST0!r} + {radius!r} * ({east}), 3) AS easting,
  round({radius!r} * ({north}) + CASE WHEN lat >= 0 THEN 0 ELSE {geodesy.NORTH0!r} END, 3) AS northing FROM u"""


@query(_utm_oracle())
def utm_forward(spark, sf_dir):
    p = load(spark, sf_dir, "supplier").selectExpr(*_LONLAT.split(", "))
    lon, lat = F.col("lon"), F.col("lat")
    east, north = geodesy.utm_forward(lon, lat)
    return p.select("id", geodesy.utm_zone(lon).alias("zone"), geodesy.utm_epsg(lon, lat).alias("epsg"), F.round(east, 3).alias("easting"), F.round(north, 3).alias("northing"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1) AND o_orderkey % 10 <> 3")
def phase_plan(spark, sf_dir):
    work = load(spark, sf_dir, "orders").select("o_orderkey")
    done = load(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"))
    return phases.still_to_do(work, done, work.where("o_orderkey % 10 = 3"), "o_orderkey")


@query("SELECT 'S1' AS stage, count(*) AS n, count(*) FILTER (x) AS n_external FROM (VALUES (true), (true), (true), (true), (true), (true), (true), (true), (true), (true), (true), (false), (true), (true), (true)) v(x)")
def stage_phases(spark, sf_dir):
    return phases.phases(spark, "S1").groupBy("stage").agg(F.count("*").alias("n"), F.count_if("external").alias("n_external"))


_TILE = "o_orderkey AS k, cast(o_orderkey * 37 % 1000 AS double) AS x, cast(o_orderkey * 91 % 1000 AS double) AS y"


@query(f"""WITH p AS (SELECT o_orderkey // 500 AS tile_id, {_TILE} FROM orders)
SELECT tile_id, x, y, round(1.1e0 * x - 0.2e0 * y + 5, 6) AS u, round(0.3e0 * x + 0.9e0 * y - 7, 6) AS v, 0.0e0 AS residual, 1.0e0 AS confidence, 1.0e0 AS inv_confidence, 'ok' AS status FROM p WHERE k % 5 <> 0""")
def match_tiles(spark, sf_dir):
    """Tiles of 500 keys, so that there are more of them in a larger table; every fifth pair is off by far."""
    pairs = load(spark, sf_dir, "orders").selectExpr("o_orderkey div 500 as tile_id", *_TILE.split(", "))
    pairs = pairs.selectExpr("tile_id", "x", "y", "1.1D * x - 0.2D * y + 5 + case when k % 5 = 0 then 300 + x else 0 end as u", "0.3D * x + 0.9D * y - 7 as v")
    return matching.match_tiles(pairs).withColumns({c: F.abs(F.round(c, 6)) for c in ("residual", "confidence", "inv_confidence")} | {c: F.round(c, 6) for c in ("u", "v")})


@query("""SELECT o_orderkey AS id, round(2.0e0 * (o_custkey % 100) + 0.1e0 * (o_orderkey % 50) + 3, 6) AS samp, round(1.5e0 * (o_orderkey % 70) - 0.2e0 * (o_orderkey % 50) + 4, 6) AS line FROM orders""")
def ground_to_image(spark, sf_dir):
    ground = load(spark, sf_dir, "orders").selectExpr("o_orderkey as id", "cast(o_custkey % 100 as double) as x", "cast(o_orderkey % 70 as double) as y", "cast(o_orderkey % 50 as double) as h")
    camera = matching.AffineCamera([[2, 0, 0.1], [0, 1.5, -0.2]], [3, 4])
    return matching.ground_to_image(ground, camera).select("id", F.round("samp", 6).alias("samp"), F.round("line", 6).alias("line"))


from skyquilt import registry_tiles  # noqa: E402, F401  it adds its queries to these
