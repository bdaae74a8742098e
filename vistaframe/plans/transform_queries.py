"""Queries over transforms, object boxes and scene evidence, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaframe.functions import geometry as G
from vistaframe.operators import cameras as C
from vistaframe.operators import frames as W
from vistaframe.operators import transforms as T
from vistaframe.plans.box_queries import floors
from vistaframe.plans.camera_queries import PROJECTED, ROT, M, seen_in_images
from vistaframe.plans.helpers import Registry, rounded
from vistaframe.sources.fixtures import view

R = Registry()


def matrix(values=M):
    return F.array(*map(F.lit, values))


def own_c2w():
    """A pose's camera-to-world matrix."""
    r = G.quat_to_rotmat(C.quaternion())
    return G.matrix_of([r[0], r[3], r[6], r[1], r[4], r[7], r[2], r[5], r[8]], G.camera_center(C.quaternion(), C.translation()))


POSED = f"c AS (SELECT *, -(r0*tx+r3*ty+r6*tz) AS ox, -(r1*tx+r4*ty+r7*tz) AS oy, -(r2*tx+r5*ty+r8*tz) AS oz FROM (SELECT *, {ROT} FROM images))"


def entries(df, m, *at):
    return rounded(df.select("scene_id", "image_id", *[F.get(m, F.lit(k)).alias(f"m{k}") for k in at]))


@R.query(f"WITH {PROJECTED} SELECT scene_id, point_id, image_id, round(u, 4) AS u, round(v, 4) AS v, round(c, 6) AS depth FROM proj WHERE model IN ('SIMPLE_PINHOLE', 'PINHOLE', 'OPENCV') AND c > 0.5", "points", "images", "cameras")
def project_c2w(spark, d):
    poses = C.poses_with_cameras(view(spark, d, "images"), view(spark, d, "cameras")).where(F.col("model").isin(*G.PROJECTED))
    poses = C.alike(poses.select("scene_id", "image_id", *C.POSE, "model", "fx", "fy", "cx", "cy")).withColumn("c2w", own_c2w())
    return seen_in_images(spark, d, poses, G.project_c2w(C.xyz(), F.col("c2w"), *[F.col(c) for c in ("model", "fx", "fy", "cx", "cy")]))


@R.query(f"WITH {POSED} SELECT scene_id, image_id, round(-2*r1, 6) AS m0, round(-2*oy+1, 6) AS m3, round(2*r3, 6) AS m5, round(2*ox+2, 6) AS m7, round(2*r8, 6) AS m10, round(2*oz+3, 6) AS m11 FROM c", "images")
def transform_pose(spark, d):
    return entries(view(spark, d, "images").withColumn("c2w", own_c2w()), G.transform_pose(F.col("c2w"), matrix()), 0, 3, 5, 7, 10, 11)


@R.query(f"WITH {POSED} SELECT scene_id, image_id, round(-r1, 6) AS m0, round(r4, 6) AS m1, round(r7, 6) AS m2, round(-2*oy+1, 6) AS m3, round(-r3, 6) AS m5, round(2*ox+2, 6) AS m7, round(-r8, 6) AS m10 FROM c", "images")
def render_camera_pose(spark, d):
    return entries(view(spark, d, "images").withColumn("c2w", own_c2w()), G.render_camera_pose(F.col("c2w"), matrix()), 0, 1, 2, 3, 5, 7, 10)


def moved(spark, d, xyz, m=None):
    """The points through xyz, which may name the matrix m as a column."""
    points = view(spark, d, "points")
    points = points if m is None else points.withColumn("m", m)
    return rounded(points.select("scene_id", "point_id", *[c.alias(n) for c, n in zip(xyz, "xyz", strict=True)]))


@R.query("SELECT scene_id, point_id, round(CASE WHEN point_id % 2 = 0 THEN -2*y+1 ELSE x END, 6) AS x, round(CASE WHEN point_id % 2 = 0 THEN 2*x+2 ELSE y END, 6) AS y, round(CASE WHEN point_id % 2 = 0 THEN 2*z+3 ELSE z END, 6) AS z FROM points", "points")
def apply_capture_transform(spark, d):
    return moved(spark, d, G.apply_capture_transform(C.xyz(), F.col("m")), F.when(F.col("point_id") % 2 == 0, matrix(M[:12])))


@R.query("SELECT scene_id, point_id, round((-2*y+1)/2, 6) AS x, round((2*x+2)/2, 6) AS y, round((2*z+3)/2, 6) AS z FROM points", "points")
def apply_trained_transform(spark, d):
    return moved(spark, d, G.apply_trained_transform(C.xyz(), matrix(M[:12]), F.lit(0.5)))


@R.query("SELECT scene_id, point_id, round(CASE WHEN point_id % 2 = 0 THEN -2*z+7 ELSE -2*y+1 END, 6) AS x, round(CASE WHEN point_id % 2 = 0 THEN 2*y-2 ELSE 2*x+2 END, 6) AS y, round(CASE WHEN point_id % 2 = 0 THEN 2*x+1 ELSE 2*z+3 END, 6) AS z FROM points", "points")
def saved_to_trained(spark, d):
    """Each point has transforms of its own; half of them were saved after (x, y, z) became (z + 1, x + 2, y + 3)."""
    applied = F.when(F.col("point_id") % 2 == 0, matrix([0.0, 0.0, 1.0, 1.0, 1.0, 0.0, 0.0, 2.0, 0.0, 1.0, 0.0, 3.0]))
    rows = T.saved_to_trained(view(spark, d, "points").withColumns({"full": matrix(), "applied": applied}), "full", "applied")
    return rounded(rows.select("scene_id", "point_id", *[c.alias(n) for c, n in zip(G.apply_transform(C.xyz(), F.col("matrix")), "xyz", strict=True)]))


@R.query(f"WITH s AS (SELECT *, {ROT}, 1 + image_id % 3 AS k FROM images) SELECT scene_id, image_id, round(k*r0, 6) AS m0, round(k*r2, 6) AS m2, round(tx, 6) AS m3, round(k*r4, 6) AS m5, round(ty, 6) AS m7, round(k*r6, 6) AS m8, round(tz, 6) AS m11, 1e0 AS m15 FROM s", "images")
def compose_similarity(spark, d):
    m = G.compose_similarity(G.quat_to_rotmat(C.quaternion()), C.translation(), (1 + F.col("image_id") % 3).cast("double"))
    return entries(view(spark, d, "images").select("scene_id", "image_id", m.alias("m")), F.col("m"), 0, 2, 3, 5, 7, 8, 11, 15)


@R.query("WITH s AS (SELECT scene_id, image_id, 0.5 + image_id % 4 AS k FROM images) SELECT scene_id, image_id, round(-k, 6) AS m1, round(0.5*k, 6) AS m3, round(k, 6) AS m4, round(k, 6) AS m7, round(k, 6) AS m10, round(1.5*k, 6) AS m11 FROM s", "images")
def apply_metric_scale(spark, d):
    return entries(view(spark, d, "images"), G.apply_metric_scale(matrix(), 0.5 + (F.col("image_id") % 4).cast("double")), 1, 3, 4, 7, 10, 11)


@R.query("SELECT k, round((1e0 + size) / (2e0 + k % 5), 6) AS metres FROM objects", "objects")
def meters_per_unit(spark, d):
    return rounded(view(spark, d, "objects").select("k", G.meters_per_unit(1.0 + F.col("size"), 2.0 + F.col("k") % 5).alias("metres")))


@R.query("SELECT a.scene_id, a.point_id, round(2*sqrt((a.x-b.x)**2 + (a.y-b.y)**2 + (a.z-b.z)**2), 6) AS length FROM points a JOIN points b ON a.scene_id = b.scene_id AND b.point_id = a.point_id + 1", "points")
def measured_length(spark, d):
    points = view(spark, d, "points").select("scene_id", "point_id", "x", "y", "z")
    after = points.select("scene_id", (F.col("point_id") - 1).alias("point_id"), *[F.col(c).alias(f"_{c}") for c in "xyz"])
    length = G.measured_length(C.xyz(), C.xyz("_"), matrix())
    return rounded(points.join(after, ["scene_id", "point_id"]).select("scene_id", "point_id", length.alias("length")))


def _boxes(spark, d):
    r = [F.col("c"), -F.col("s"), F.lit(0.0), F.col("s"), F.col("c"), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)]
    half = dict(zip(("hx", "hy", "hz"), (1.0, 2.0, 0.5), strict=True))
    return view(spark, d, "boxes3d").select("scene_id", "k", "cx", "cy", "cz", *[x.alias(f"r{k}") for k, x in enumerate(r)], *[F.lit(v).alias(n) for n, v in half.items()])


@R.query("WITH e AS (SELECT *, CASE WHEN i & 1 = 0 THEN -1e0 ELSE 1e0 END AS ex, CASE WHEN i & 2 = 0 THEN -2e0 ELSE 2e0 END AS ey, CASE WHEN i & 4 = 0 THEN -0.5e0 ELSE 0.5e0 END AS ez FROM boxes3d CROSS JOIN range(8) t(i)) SELECT k, i::INT AS corner, round(cx+c*ex-s*ey, 6) AS x, round(cy+s*ex+c*ey, 6) AS y, round(cz+ez, 6) AS z FROM e", "boxes3d")
def obb_corners(spark, d):
    return rounded(T.obb_corners(_boxes(spark, d)).select("k", "corner", "x", "y", "z"))


@R.query("SELECT k, round(CASE WHEN w THEN (-2*cy+1)/2 ELSE cx END, 6) AS cx, round(CASE WHEN w THEN (2*cx+2)/2 ELSE cy END, 6) AS cy, round(CASE WHEN w THEN (2*cz+3)/2 ELSE cz END, 6) AS cz, round(CASE WHEN w THEN -s ELSE c END, 6) AS r0, round(CASE WHEN w THEN -c ELSE -s END, 6) AS r1, round(CASE WHEN w THEN c ELSE s END, 6) AS r3, round(CASE WHEN w THEN -s ELSE c END, 6) AS r4, 1e0 AS r8, CASE WHEN w THEN 1e0 ELSE 2e0 END AS hy FROM (SELECT *, scene_id < 's7' AS w FROM boxes3d)", "boxes3d")
def transform_obb(spark, d):
    transforms = view(spark, d, "boxes3d").where("scene_id < 's7'").select("scene_id").distinct().select("scene_id", matrix().alias("matrix"), F.lit(0.5).alias("scale"))
    return rounded(T.transform_obb(_boxes(spark, d), transforms).select("k", "cx", "cy", "cz", "r0", "r1", "r3", "r4", "r8", "hy"))


@R.query("SELECT concat(scene_id, '_', image_id) AS scene_id, CASE WHEN image_id % 5 = 0 THEN 1e0 ELSE -4e0 END AS m0, CASE WHEN image_id % 5 = 0 THEN 0e0 ELSE -3e0 END AS m3, CASE WHEN image_id % 5 = 0 THEN 0e0 ELSE 4e0 END AS m7, CASE WHEN image_id % 5 = 0 THEN 0e0 ELSE 9e0 END AS m11, image_id % 5 = 0 AS warned FROM images", "images")
def source_to_target(spark, d):
    """Each image as a scene; two edges lead to the world, of which every fifth scene lacks one."""
    scenes = view(spark, d, "images").select(F.concat_ws("_", "scene_id", "image_id").alias("scene_id"), "image_id", F.lit("preview").alias("build_mode"))
    one = scenes.select("scene_id", F.lit(0).alias("ordinal"), F.lit("colmap").alias("source"), F.lit("mid").alias("target"), matrix().alias("matrix"))
    two = scenes.where("image_id % 5 <> 0").select("scene_id", F.lit(1).alias("ordinal"), F.lit("mid").alias("source"), F.lit("usd").alias("target"), matrix().alias("matrix"))
    found = T.source_to_target(scenes, W.frame_paths(one.unionByName(two)))
    return rounded(found.select("scene_id", *[F.element_at("matrix", k + 1).alias(f"m{k}") for k in (0, 3, 7, 11)], F.col("warning").isNotNull().alias("warned")))


def _scenes(spark, d):
    """Each object as a scene of its own."""
    return view(spark, d, "objects").withColumn("scene_id", F.col("instance_id"))


@R.query("SELECT instance_id AS scene_id, CASE WHEN k % 3 = 0 THEN 'floor' WHEN size % 2 = 0 THEN 'e0' WHEN size % 5 <> 0 THEN 'e1' END AS evidence FROM objects", "objects")
def resolve_floor_transform(spark, d):
    s = _scenes(spark, d)
    edges = [s.select("scene_id", F.lit(i).alias("ordinal"), F.lit(f"e{i}").alias("evidence"), there.alias("file_exists")) for i, there in ((0, F.col("size") % 2 == 0), (1, F.col("size") % 5 != 0))]
    return T.resolve_floor_transform(s, s.where("k % 3 = 0").select("scene_id", F.lit("floor").alias("path")), edges[1].unionByName(edges[0]))


@R.query("SELECT instance_id AS scene_id, k % 2 = 0 AS has_cloud, k % 3 = 0 AS has_floor, size % 4 = 0 OR k % 7 = 0 AS approved, CASE WHEN k % 11 <> 0 THEN CAST(size AS DOUBLE) END AS scale, CASE WHEN k % 11 <> 0 THEN 'anchor' END AS scale_method, k % 6 = 0 AS ready FROM objects WHERE k % 11 <> 0 UNION ALL SELECT instance_id, k % 2 = 0, k % 3 = 0, k % 7 = 0, NULL, NULL, k % 6 = 0 FROM objects WHERE k % 11 = 0", "objects")
def metric_scene_state(spark, d):
    s = _scenes(spark, d)
    floors = s.where("k % 3 = 0").select("scene_id", matrix().alias("matrix"))
    scales = s.where("k % 11 <> 0").select("scene_id", F.lit("anchor").alias("method"), F.col("size").cast("double").alias("meters_per_unit"), (F.col("size") % 4 == 0).alias("approved"))
    gates = s.select("scene_id", F.lit("metric_transform").alias("gate"), F.when(F.col("k") % 7 == 0, "approved").otherwise("pending").alias("state"))
    return T.metric_scene_state(s, s.where("k % 2 = 0"), floors, scales, gates)


@R.query("SELECT instance_id AS scene_id, CASE WHEN k % 2 = 0 THEN 3 ELSE 2 END AS edges, CASE WHEN k % 2 = 0 THEN 'approved_similarity_registration' ELSE 'old' END AS method, round(CASE WHEN k % 2 = 0 THEN 2e0 ELSE 7e0 END, 6) AS metres, CASE WHEN k % 2 = 0 THEN 'approved' ELSE 'pending' END AS state FROM objects", "objects")
def set_metric_transform(spark, d):
    s = _scenes(spark, d)
    edge = lambda i, a, b: s.select("scene_id", F.lit(i).alias("ordinal"), F.lit(a).alias("source_frame"), F.lit(b).alias("target_frame"), matrix().alias("matrix"), F.lit(1.0).alias("confidence"), F.lit("x").alias("evidence"))
    scales = s.select("scene_id", F.lit("old").alias("method"), F.lit(7.0).alias("meters_per_unit"), F.lit(0.1).alias("confidence"), F.lit("r").alias("reference"), F.lit(False).alias("approved"))
    gates = s.select("scene_id", F.lit("metric_transform").alias("gate"), F.lit("pending").alias("state"), F.lit("none").alias("reviewer"))
    new = s.where("k % 2 = 0").select("scene_id", matrix().alias("matrix"), F.lit(0.9).alias("confidence"), F.lit("y").alias("evidence"))
    edges, scaled, approved = T.set_metric_transform(edge(0, "colmap", "usd").unionByName(edge(4, "a", "b")), scales, gates, new, "me")
    places = edges.groupBy("scene_id").agg(F.max(F.when(F.col("source_frame") == "colmap", F.when(F.col("evidence") == "y", F.lit(3) + 0 * F.col("ordinal")).otherwise(2))).alias("edges"))
    return rounded(places.join(scaled.select("scene_id", "method", F.col("meters_per_unit").alias("metres")), "scene_id").join(approved.select("scene_id", "state"), "scene_id"))


@R.query("SELECT instance_id AS scene_id, CASE WHEN k % 4 = 0 THEN 'calibrated_registration' WHEN size % 3 = 0 THEN 'metric_sensor' WHEN size % 3 = 1 THEN 'known_length_pending_measurement' ELSE 'unknown' END AS method, CASE WHEN k % 4 = 0 THEN 0.5e0 WHEN size % 3 = 0 THEN 1e0 END AS metres, CASE WHEN k % 4 = 0 THEN 0.8e0 WHEN size % 3 = 0 THEN 0.95e0 WHEN size % 3 = 1 THEN 0.5e0 ELSE 0e0 END AS confidence, k % 4 = 0 OR size % 3 = 0 AS approved, CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END AS captures, k % 4 <> 0 AS warned FROM objects", "objects")
def init_scenes(spark, d):
    s = _scenes(spark, d)
    known = F.col("k") % 4 == 0
    options = s.select(
        "scene_id", F.lit("preview").alias("build_mode"), F.lit("p").alias("path"), F.when(F.col("size") % 3 == 0, "lidar").otherwise("rgb").alias("modality"), F.when(known, "c.json").alias("calibration_path"), F.when(F.col("size") % 3 == 1, 1.2).alias("scale_anchor_m"),
        F.when(F.col("k") % 5 == 0, "plate").alias("clean_plate_path"), F.when(known, matrix()).alias("matrix"), F.when(known, 0.5).alias("meters_per_unit"), F.when(known, 0.8).alias("registration_confidence"), F.when(known, True).alias("calibration_approved"),
    )
    made = T.init_scenes(options)
    captures = made["captures"].groupBy("scene_id").agg(F.count(F.lit(1)).alias("captures"))
    warned = made["warnings"].select("scene_id", F.lit(True).alias("_w"))
    rows = made["scales"].join(captures, "scene_id").join(warned, "scene_id", "left")
    return rows.select("scene_id", "method", F.col("meters_per_unit").alias("metres"), "confidence", "approved", "captures", F.coalesce("_w", F.lit(False)).alias("warned"))


@R.query("SELECT scene_id, round(below, 6) AS below, CASE WHEN below > 0.4 THEN 'below' WHEN ratio < 0.02 THEN 'ratio' WHEN above < 0.9 THEN 'cameras' END AS problem FROM (SELECT instance_id AS scene_id, size / 1e2 AS below, (k % 10) / 1e2 AS ratio, (k % 7) / 6e0 AS above FROM objects)", "objects")
def floor_gate(spark, d):
    s = _scenes(spark, d).select("scene_id", (F.col("size") / 100.0).alias("below"), (F.col("k") % 10 / 100.0).alias("ratio"), (F.col("k") % 7 / 6.0).alias("cameras_above"))
    return rounded(W.floor_gate(s, 0.4, 0.02).select("scene_id", "below", "problem"))


UPS = "SELECT scene_id, " + ", ".join(f"CASE WHEN l > 1e-9 THEN {c}/l ELSE {int(c == 'z')} END AS u{c}" for c in "xyz") + f" FROM (SELECT *, sqrt(x*x+y*y+z*z) AS l FROM (SELECT scene_id, avg(-r3) AS x, avg(-r4) AS y, avg(-r5) AS z FROM (SELECT *, {ROT} FROM images) GROUP BY 1))"
ROT_UP = "[1-nx*nx/(1+nz), -nx*ny/(1+nz), -nx, -nx*ny/(1+nz), 1-ny*ny/(1+nz), -ny, nx, ny, nz]"
ALIGNED = f"""{floors(UPS)}, rt AS (SELECT *, {ROT_UP} AS turn FROM fl),
mid AS (SELECT scene_id, median(turn[1]*x+turn[2]*y+turn[3]*z) AS tx, median(turn[4]*x+turn[5]*y+turn[6]*z) AS ty, avg(CASE WHEN nx*x+ny*y+nz*z-off < -0.04 THEN 1e0 ELSE 0e0 END) AS below FROM points JOIN rt USING (scene_id) GROUP BY 1),
ab AS (SELECT scene_id, avg(CASE WHEN -nx*(r0*tx+r3*ty+r6*tz)-ny*(r1*tx+r4*ty+r7*tz)-nz*(r2*tx+r5*ty+r8*tz)-off > 0 THEN 1e0 ELSE 0e0 END) AS above FROM (SELECT *, {ROT} FROM images) JOIN fl USING (scene_id) GROUP BY 1)"""
MATRIX = ", ".join(f"round({f'turn[{3 * (k // 4) + k % 4 + 1}]' if k % 4 < 3 else ('-tx', '-ty', '-off')[k // 4]}, 6) + 0e0 AS m{k}" for k in range(12))


@R.query(f"WITH {ALIGNED} SELECT scene_id, {MATRIX}, round(least(1.5*ratio, 1), 6) AS confidence, round(below, 6) AS below, round(coalesce(above, 1), 6) AS cameras_above, round(ratio, 6) AS ratio, CASE WHEN below > 1 THEN 'below' WHEN ratio < 0 THEN 'ratio' WHEN coalesce(above, 1) < 0.9 THEN 'cameras' END AS problem FROM rt JOIN mid USING (scene_id) LEFT JOIN ab USING (scene_id)", "points", "images")
def align_scene(spark, d):
    found = W.align_scene(view(spark, d, "points"), view(spark, d, "images"), strict=False)
    return rounded(found.select("scene_id", *[F.element_at("matrix", k + 1).alias(f"m{k}") for k in range(12)], "confidence", "below", "cameras_above", "ratio", "problem"))
