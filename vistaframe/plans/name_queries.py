"""Queries over names, keys and small rules, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaframe.functions import geometry as G
from vistaframe.functions import names as N
from vistaframe.operators import cameras as C
from vistaframe.operators import frames as W
from vistaframe.operators import quality as Q
from vistaframe.plans.helpers import Registry, rounded
from vistaframe.sources.fixtures import view

R = Registry()


@R.query("SELECT frame_id, replace(regexp_replace(path, '\\.[^./]*$', ''), '/', '_') AS label_key FROM frames", "frames")
def frame_label_key(spark, d):
    return view(spark, d, "frames").select("frame_id", N.frame_label_key(F.concat(F.lit("./"), "path")).alias("label_key"))


@R.query("SELECT frame_id, frame_id AS frame FROM frames", "frames")
def frame_index(spark, d):
    return view(spark, d, "frames").select("frame_id", N.frame_index(F.upper(N.stem(F.col("path")))).alias("frame"))


@R.query("SELECT frame_id, coalesce(TRY_CAST(regexp_extract(path, '[0-9]+') AS BIGINT), 0) AS sort_key FROM frames", "frames")
def frame_sort_key(spark, d):
    return view(spark, d, "frames").select("frame_id", N.frame_sort_key(F.col("path")).alias("sort_key"))


@R.query("SELECT frame_id, CASE frame_id % 3 WHEN 0 THEN regexp_extract(path, '^(.*)/', 1) WHEN 1 THEN regexp_extract(path, '^(.*)/', 1) ELSE 'default' END AS session FROM frames", "frames")
def session_of(spark, d):
    """Folders, names with a double underscore, and names alone."""
    f = view(spark, d, "frames")
    name = F.when(F.col("frame_id") % 3 == 0, F.col("path")).when(F.col("frame_id") % 3 == 1, F.replace("path", F.lit("/"), F.lit("__"))).otherwise(F.regexp_extract("path", "[^/]*$", 0))
    return f.select("frame_id", N.session_of(name).alias("session"))


@R.query("SELECT ordinal, array_to_string(list_transform(string_split(replace(class_name, '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title FROM detections", "detections")
def display_name(spark, d):
    return view(spark, d, "detections").select("ordinal", N.display_name(F.col("class_name")).alias("title"))


@R.query("SELECT frame_id, frame_id % 4 < 2 AS video FROM frames", "frames")
def supported_video(spark, d):
    ending = F.element_at(F.array(*[F.lit(s) for s in (".MP4", ".mov", ".jpg", "")]), (F.col("frame_id") % 4 + 1).cast("int"))
    return view(spark, d, "frames").select("frame_id", N.supported_video(F.concat(N.stem(F.col("path")), ending)).alias("video"))


@R.query("SELECT scene_id, camera_id, round(CASE camera_id % 3 WHEN 0 THEN degrees(2 * atan(tan(0.5) * height / width)) WHEN 1 THEN degrees(2 * atan(height / (fx + fy))) ELSE 60 END, 6) AS fov FROM cameras", "cameras")
def fov_deg(spark, d):
    kind = F.col("camera_id") % 3
    focal = lambda c: F.when(kind == 1, F.col(c))
    found = G.fov_deg(focal("fx"), focal("fy"), F.when(kind == 0, 1.0), F.col("width"), F.col("height"))
    return rounded(view(spark, d, "cameras").select("scene_id", "camera_id", found.alias("fov")))


@R.query(f"WITH n AS (SELECT scene_id, point_id, x/l AS x, y/l AS y, z/l AS z FROM (SELECT *, sqrt(x*x+y*y+z*z) AS l FROM points) WHERE l > 1e-6) SELECT scene_id, point_id, {', '.join(f'round({t}, 6) + 0e0 AS r{k}' for k, t in enumerate(('1-x*x/(1+z)', '-x*y/(1+z)', '-x', '-x*y/(1+z)', '1-y*y/(1+z)', '-y', 'x', 'y', 'z')))} FROM n WHERE abs(z) < 0.999", "points")
def rotation_to_up(spark, d):
    length = G.norm([F.col(c) for c in "xyz"])
    unit = view(spark, d, "points").withColumn("l", length).where("l > 1e-6").select("scene_id", "point_id", *[(F.col(c) / F.col("l")).alias(c) for c in "xyz"]).where("abs(z) < 0.999")
    return rounded(unit.select("scene_id", "point_id", *[t.alias(f"r{k}") for k, t in enumerate(G.rotation_to_up([F.col(c) for c in "xyz"]))]))


@R.query("SELECT ordinal, round(least(greatest(1.5 * (20 * min_opacity - 0.3), 0), 1), 6) AS confidence FROM trials", "trials")
def alignment_confidence(spark, d):
    return rounded(view(spark, d, "trials").select("ordinal", W.alignment_confidence(20 * F.col("min_opacity") - 0.3).alias("confidence")))


@R.query("SELECT scene_id, count(*) FILTER (image_id % 3 <> 0) AS registered, count(*) AS candidates, round(count(*) FILTER (image_id % 3 <> 0) / count(*), 6) AS rate, count(*) FILTER (image_id % 3 <> 0) / count(*) >= 0.65 AS passed FROM images GROUP BY 1", "images")
def registration_rate(spark, d):
    images = view(spark, d, "images")
    return rounded(C.registration_rate(images.select("scene_id", "name"), images.where("image_id % 3 <> 0"), 0.65))


@R.query("SELECT scene_id, image_id, name FROM images QUALIFY row_number() OVER (PARTITION BY scene_id ORDER BY name, image_id) <= 3", "images")
def first_poses(spark, d):
    return C.first_poses(view(spark, d, "images"), 3).select("scene_id", "image_id", "name")


@R.query("SELECT scene_id, max(k) % 3 <> 0 AND bool_or(k % 5 = 0) AND bool_or(review_state = 'approved') AS ready FROM objects GROUP BY 1", "objects")
def production_gate(spark, d):
    objects = view(spark, d, "objects")
    scale = objects.groupBy("scene_id").agg((F.max("k") % 3 != 0).alias("metric"))
    return Q.production_gate(scale, objects.select("scene_id", (F.col("k") % 5 == 0).alias("reaches")), objects.select("scene_id", F.col("review_state").alias("state")))
