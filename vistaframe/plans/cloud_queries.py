"""Queries over point and Gaussian clouds, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaframe.operators import cloud as C
from vistaframe.operators import spatial as S
from vistaframe.operators.cameras import view_counts
from vistaframe.operators.held import SPREAD
from vistaframe.plans.helpers import Registry, rounded
from vistaframe.sources.fixtures import view

R = Registry()

STATS = """own AS (SELECT scene_id, quantile_cont(x, 0.02) AS lo_x, quantile_cont(x, 0.98) AS hi_x, quantile_cont(y, 0.02) AS lo_y, quantile_cont(y, 0.98) AS hi_y, quantile_cont(z, 0.02) AS lo_z, quantile_cont(z, 0.98) AS hi_z FROM gaussians GROUP BY 1),
stats AS (SELECT *, greatest(hi_x-lo_x, 1e-9) AS span_x, greatest(hi_y-lo_y, 1e-9) AS span_y, greatest(hi_z-lo_z, 1e-9) AS span_z, sqrt(greatest(hi_x-lo_x, 1e-9)**2 + greatest(hi_y-lo_y, 1e-9)**2 + greatest(hi_z-lo_z, 1e-9)**2) AS diagonal FROM own)"""


@R.query("SELECT scene_id, " + ", ".join(f"round(CASE WHEN count(*) >= 32 THEN quantile_cont({c}, {q}) END, 6) AS {n}_{c}" for n, q in (("lo", 0.02), ("hi", 0.98)) for c in "xyz") + " FROM points GROUP BY 1", "points")
def observed_bounds(spark, d):
    return rounded(C.observed_bounds(view(spark, d, "points")))


@R.query(f"WITH {STATS} SELECT scene_id, round(lo_x, 6) AS lo_x, round(hi_z, 6) AS hi_z, round(span_y, 6) AS span_y, round(diagonal, 6) AS diagonal FROM stats", "gaussians")
def scene_stats(spark, d):
    return rounded(C.scene_stats(view(spark, d, "gaussians")).select("scene_id", "lo_x", "hi_z", "span_y", "diagonal"))


@R.query("SELECT scene_id, round(min(x), 6) AS min_x, round(min(y), 6) AS min_y, round(min(z), 6) AS min_z, round(max(x), 6) AS max_x, round(max(y), 6) AS max_y, round(max(z), 6) AS max_z FROM points GROUP BY 1", "points")
def extent(spark, d):
    return rounded(C.extent(view(spark, d, "points")))


@R.query("SELECT scene_id, gaussian_id FROM gaussians WHERE opacity >= 0.05", "gaussians")
def opacity_filter(spark, d):
    return view(spark, d, "gaussians").where(~C.too_faint(0.05)).select("scene_id", "gaussian_id")


def _with_stats(spark, d):
    g = view(spark, d, "gaussians")
    return g.join(F.broadcast(C.scene_stats(g)), "scene_id")


@R.query(f"WITH {STATS} SELECT scene_id, gaussian_id FROM gaussians JOIN stats USING (scene_id) WHERE greatest(sx, sy, sz) <= least(5, 0.1 * diagonal)", "gaussians")
def scale_filter(spark, d):
    return _with_stats(spark, d).where(~C.too_large(5.0, 0.1)).select("scene_id", "gaussian_id")


@R.query(f"WITH {STATS} SELECT scene_id, gaussian_id FROM gaussians JOIN stats USING (scene_id) WHERE NOT (greatest(sx, sy, sz) / greatest(list_sort([sx, sy, sz])[2], 1e-12) > 4 AND greatest(sx, sy, sz) > 0.001 * diagonal)", "gaussians")
def needle_filter(spark, d):
    return _with_stats(spark, d).where(~C.too_thin(4.0, 0.001)).select("scene_id", "gaussian_id")


@R.query(f"WITH {STATS} SELECT scene_id, gaussian_id FROM gaussians JOIN stats USING (scene_id) WHERE x BETWEEN lo_x - 0.1*span_x AND hi_x + 0.1*span_x AND y BETWEEN lo_y - 0.1*span_y AND hi_y + 0.1*span_y AND z BETWEEN lo_z - 0.1*span_z AND hi_z + 0.1*span_z", "gaussians")
def crop_filter(spark, d):
    return _with_stats(spark, d).where(~C.outside(0.1)).select("scene_id", "gaussian_id")


NEAR = "near AS (SELECT a.scene_id, a.point_id AS id, count(*) - 1 AS neighbors FROM points a JOIN points b ON a.scene_id = b.scene_id AND (a.x-b.x)**2 + (a.y-b.y)**2 + (a.z-b.z)**2 <= 0.25 GROUP BY ALL)"


@R.query(f"WITH {NEAR} SELECT * FROM near", "points")
def neighbor_counts(spark, d):
    return S.neighbor_counts(view(spark, d, "points").select("scene_id", F.col("point_id").alias("id"), "x", "y", "z"), 0.5)


@R.query("SELECT a.scene_id, a.point_id AS a_id, b.point_id AS b_id, round(sqrt((a.x-b.x)**2 + (a.y-b.y)**2 + (a.z-b.z)**2), 6) AS distance FROM points a JOIN points b ON a.scene_id = b.scene_id AND (a.x-b.x)**2 + (a.y-b.y)**2 + (a.z-b.z)**2 <= 0.16", "points")
def radius_join(spark, d):
    points = view(spark, d, "points").select("scene_id", F.col("point_id").alias("id"), "x", "y", "z")
    return rounded(S.radius_join(points, points, 0.4, max(SPREAD, int(spark.conf.get("spark.sql.shuffle.partitions")))))


@R.query("SELECT a.scene_id, a.point_id AS a_id, arg_min(b.point_id, sqrt((a.x-b.x)**2 + (a.y-b.y)**2 + (a.z-b.z)**2)) AS b_id, round(min(sqrt((a.x-b.x)**2 + (a.y-b.y)**2 + (a.z-b.z)**2)), 6) AS distance FROM points a JOIN points b ON a.scene_id = b.scene_id AND a.point_id % 2 = 0 AND b.point_id % 2 = 1 GROUP BY ALL", "points")
def nearest_join(spark, d):
    points = view(spark, d, "points").select("scene_id", F.col("point_id").alias("id"), "x", "y", "z")
    return rounded(S.nearest_join(points.where("id % 2 = 0"), points.where("id % 2 = 1"), 0.5))


LIMITS = """c AS (SELECT scene_id, count(*) AS n, median(x) AS mx, median(y) AS my, median(z) AS mz FROM {rows} GROUP BY 1 HAVING count(*) >= 8),
far AS (SELECT r.*, sqrt((x-mx)**2+(y-my)**2+(z-mz)**2) AS dist FROM {rows} r JOIN c USING (scene_id)),
md AS (SELECT scene_id, median(dist) AS md, stddev_pop(dist) AS sd FROM far GROUP BY 1),
lim AS (SELECT scene_id, CASE WHEN 1.4826*median(abs(dist-md)) < 1e-9 THEN any_value(sd)+1e-9 ELSE 1.4826*median(abs(dist-md)) END * {k} AS lim FROM far JOIN md USING (scene_id) GROUP BY 1)"""


@R.query(f"WITH {LIMITS.format(rows='gaussians', k=3)} SELECT scene_id, gaussian_id, coalesce(dist > lim, false) AS far FROM far LEFT JOIN lim USING (scene_id)", "gaussians")
def mad_radius_filter(spark, d):
    return C.mad_radius_filter(view(spark, d, "gaussians"), 3.0).select("scene_id", "gaussian_id", "far")


CLEANED = f"""{STATS},
r0 AS (SELECT g.*, CASE WHEN opacity < 0.05 THEN 'opacity' WHEN greatest(sx, sy, sz) > least(5, 0.2*diagonal) THEN 'scale'
  WHEN greatest(sx, sy, sz) / greatest(list_sort([sx, sy, sz])[2], 1e-12) > 6 AND greatest(sx, sy, sz) > 0.001*diagonal THEN 'needle'
  WHEN NOT (x BETWEEN lo_x - 0.5*span_x AND hi_x + 0.5*span_x AND y BETWEEN lo_y - 0.5*span_y AND hi_y + 0.5*span_y AND z BETWEEN lo_z - 0.5*span_z AND hi_z + 0.5*span_z) THEN 'crop' END AS reason
  FROM gaussians g JOIN stats USING (scene_id)),
s0 AS (SELECT * FROM r0 WHERE reason IS NULL),
n0 AS (SELECT a.scene_id, a.gaussian_id, count(*) - 1 AS n FROM s0 a JOIN s0 b ON a.scene_id = b.scene_id AND (a.x-b.x)**2+(a.y-b.y)**2+(a.z-b.z)**2 <= 0.36 GROUP BY ALL),
t0 AS (SELECT scene_id, count(*) AS total FROM s0 GROUP BY 1),
r1 AS (SELECT r0.* REPLACE (coalesce(reason, CASE WHEN total > 2 AND n < 2 THEN 'density' END) AS reason) FROM r0 LEFT JOIN n0 USING (scene_id, gaussian_id) LEFT JOIN t0 USING (scene_id)),
rot AS (SELECT *, 1-2*(qy*qy+qz*qz) AS r0, 2*(qx*qy-qw*qz) AS r1, 2*(qx*qz+qw*qy) AS r2, 2*(qx*qy+qw*qz) AS r3, 1-2*(qx*qx+qz*qz) AS r4, 2*(qy*qz-qw*qx) AS r5, 2*(qx*qz-qw*qy) AS r6, 2*(qy*qz+qw*qx) AS r7, 1-2*(qx*qx+qy*qy) AS r8 FROM images JOIN cameras USING (scene_id, camera_id)),
cam AS (SELECT p.scene_id, p.gaussian_id, fx, CASE WHEN model LIKE '%RADIAL' OR model = 'SIMPLE_PINHOLE' THEN fx ELSE fy END AS fy, cx, cy, width, height, r0*x+r1*y+r2*z+tx AS a, r3*x+r4*y+r5*z+ty AS b, r6*x+r7*y+r8*z+tz AS c FROM r1 p JOIN rot USING (scene_id)),
seen AS (SELECT scene_id, gaussian_id, count(*) AS views FROM cam WHERE c > 1e-6 AND fx*a/(c+1e-12)+cx >= 0 AND fx*a/(c+1e-12)+cx < width AND fy*b/(c+1e-12)+cy >= 0 AND fy*b/(c+1e-12)+cy < height GROUP BY ALL),
r2 AS (SELECT r1.* REPLACE (coalesce(reason, CASE WHEN coalesce(views, 0) < 1 THEN 'views' END) AS reason) FROM r1 LEFT JOIN seen USING (scene_id, gaussian_id)),
s2 AS (SELECT * FROM r2 WHERE reason IS NULL),
{LIMITS.format(rows='s2', k=2)},
r3 AS (SELECT r2.scene_id, r2.gaussian_id, coalesce(reason, CASE WHEN dist > lim THEN 'outlier' END) AS reason FROM r2 LEFT JOIN (SELECT scene_id, gaussian_id, dist FROM far) f USING (scene_id, gaussian_id) LEFT JOIN lim USING (scene_id))"""


def _cleaned(spark, d):
    g = view(spark, d, "gaussians")
    views = view_counts(g.withColumnRenamed("gaussian_id", "point_id"), view(spark, d, "images"), view(spark, d, "cameras")).withColumnRenamed("point_id", "gaussian_id")
    return C.clean_gaussians(g, None, views, min_opacity=0.05, max_scale=5.0, scale_share=0.2, needle_ratio=6.0, needle_share=0.001, crop_margin=0.5, density_radius=0.6, density_least=2, min_views=1, outlier_std=2.0)


@R.query(f"WITH {CLEANED} SELECT scene_id, gaussian_id, reason FROM r3", "gaussians", "images", "cameras")
def clean_gaussians(spark, d):
    return _cleaned(spark, d).select("scene_id", "gaussian_id", "reason")


@R.query(f"WITH {CLEANED} SELECT scene_id, count(*) AS input, count(*) FILTER (reason IS NULL) AS kept, " + ", ".join(f"count(*) FILTER (reason = '{r}') AS removed_{r}" for r in C.RULES) + " FROM r3 GROUP BY 1", "gaussians", "images", "cameras")
def cleanup_report(spark, d):
    return C.cleanup_report(_cleaned(spark, d))


@R.query(f"WITH {CLEANED} SELECT scene_id, count(*) FILTER (reason IS NULL) AS kept, " + ", ".join(f"round(count(*) FILTER (reason = '{r}') / count(*), 6) AS share_{r}" for r in C.RULES) + " FROM r3 GROUP BY 1", "gaussians", "images", "cameras")
def cleanliness(spark, d):
    return rounded(C.cleanliness(C.cleanup_report(_cleaned(spark, d))))


@R.query("WITH q AS (SELECT scene_id, r % 4 AS part, " + ", ".join(f"quantile_cont({c}, 0.05) AS l{c}, quantile_cont({c}, 0.95) AS h{c}" for c in "xyz") + " FROM points GROUP BY ALL) SELECT scene_id, part, " + ", ".join(f"round((l{c}+h{c})/2 - least((h{c}-l{c})/2, 1.0), 6) AS lo_{c}, round((l{c}+h{c})/2 + least((h{c}-l{c})/2, 1.0), 6) AS hi_{c}" for c in "xyz") + " FROM q", "points")
def trimmed_aabb(spark, d):
    return rounded(C.trimmed_aabb(view(spark, d, "points").withColumn("part", F.col("r") % 4), ["scene_id", "part"], max_extent=2.0))


@R.query("WITH c AS (SELECT scene_id, quantile_cont(opacity, 0.25) AS q FROM gaussians GROUP BY 1) SELECT scene_id, gaussian_id FROM gaussians JOIN c USING (scene_id) WHERE opacity > q", "gaussians")
def visibility_percentile_cut(spark, d):
    return C.visibility_percentile_cut(view(spark, d, "gaussians").withColumn("visibility", F.col("opacity")), 0.25).select("scene_id", "gaussian_id")


@R.query("SELECT scene_id, count(*) FILTER (opacity = 0) AS zeros, " + ", ".join(f"round(quantile_cont(opacity, {q}), 6) AS {n}" for n, q in (("p0_1", 0.001), ("p1", 0.01), ("p5", 0.05), ("p10", 0.1), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p100", 1))) + " FROM gaussians GROUP BY 1", "gaussians")
def visibility_distribution(spark, d):
    return rounded(C.visibility_distribution(view(spark, d, "gaussians").withColumn("visibility", F.col("opacity"))))


@R.query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY point_id) - 1 AS pos, count(*) OVER (PARTITION BY scene_id) AS n FROM points), w AS (SELECT DISTINCT scene_id, CAST(trunc(k * ((n - 1) / 49e0)) AS BIGINT) AS pos FROM (SELECT DISTINCT scene_id, n FROM r) CROSS JOIN range(50) t(k) WHERE n > 50) SELECT r.scene_id, r.point_id FROM r LEFT JOIN w USING (scene_id, pos) WHERE n <= 50 OR w.pos IS NOT NULL", "points")
def linspace_sample(spark, d):
    return S.linspace_sample(view(spark, d, "points"), "scene_id", ["point_id"], 50).select("scene_id", "point_id")


@R.query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY point_id) - 1 AS pos, greatest(1, count(*) OVER (PARTITION BY scene_id) // 64) AS step FROM points) SELECT scene_id, point_id FROM r WHERE pos % step = 0 AND pos // step < 64", "points")
def strided_sample(spark, d):
    return S.strided_sample(view(spark, d, "points"), "scene_id", ["point_id"], 64).select("scene_id", "point_id")
