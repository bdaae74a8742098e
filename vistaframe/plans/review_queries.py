"""Queries over gates, reviews and poses, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaframe.operators import masks as K
from vistaframe.operators import review as V
from vistaframe.plans.helpers import Registry, rounded
from vistaframe.sources.fixtures import view

R = Registry()

SCENES = "sc AS (SELECT image_id AS k, concat('c', image_id) AS scene_id, CASE image_id % 2 WHEN 0 THEN 'production' ELSE 'preview' END AS build_mode, CASE image_id % 3 WHEN 0 THEN 'rgb' WHEN 1 THEN 'rgbd' ELSE 'lidar' END AS modality, image_id % 5 <> 0 AS metric, CASE WHEN image_id % 4 = 0 THEN 'unknown' ELSE 'anchor' END AS method FROM images)"


def _scenes(spark, d):
    k = F.col("image_id")
    return view(spark, d, "images").select(
        k.alias("k"), F.concat(F.lit("c"), k.cast("string")).alias("scene_id"), F.when(k % 2 == 0, "production").otherwise("preview").alias("build_mode"),
        F.when(k % 3 == 0, "rgb").when(k % 3 == 1, "rgbd").otherwise("lidar").alias("modality"), (k % 5 != 0).alias("metric"), F.when(k % 4 == 0, "unknown").otherwise("anchor").alias("method"),
    )


@R.query(f"WITH {SCENES} SELECT scene_id, CASE WHEN build_mode = 'production' AND NOT metric THEN 'scale' WHEN build_mode = 'production' AND modality = 'rgb' AND method = 'unknown' THEN 'anchor' END AS problem FROM sc", "images")
def geometry_gate(spark, d):
    return V.geometry_gate(_scenes(spark, d)).select("scene_id", "problem")


@R.query(f"WITH {SCENES} SELECT scene_id, build_mode = 'production' AND modality <> 'rgb' AS required, CASE WHEN k % 7 = 0 THEN NOT (build_mode = 'production' AND modality <> 'rgb') ELSE k % 10 / 100e0 <= 0.05 END AS passed FROM sc", "images")
def depth_gate(spark, d):
    rows = _scenes(spark, d).withColumn("median_error", F.when(F.col("k") % 7 != 0, F.col("k") % 10 / 100.0))
    return V.depth_gate(rows, 0.05).select("scene_id", "required", "passed")


OBJECTS = "ob AS (SELECT scene_id, concat('o', o) AS instance_id, o % 2 = 0 AS movable, CASE (k + o) % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'pending' ELSE 'rejected' END AS state, (k + o) % 10 / 10e0 AS coverage, (k * o) % 6 AS masks FROM sc CROSS JOIN range(4) t(o))"


def _objects(spark, d):
    o = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("o")
    rows = _scenes(spark, d).select("scene_id", "k", o)
    mix = F.col("k") + F.col("o")
    return rows.select("scene_id", F.concat(F.lit("o"), F.col("o").cast("string")).alias("instance_id"), (F.col("o") % 2 == 0).alias("movable"), F.when(mix % 3 == 0, "approved").when(mix % 3 == 1, "pending").otherwise("rejected").alias("state"), (mix % 10 / 10.0).alias("coverage"), ((F.col("k") * F.col("o")) % 6).alias("masks"))


@R.query(f"WITH {SCENES}, {OBJECTS}, u AS (SELECT scene_id, array_to_string(list(instance_id ORDER BY instance_id), ',') AS ids FROM ob WHERE movable AND state = 'approved' AND coverage < 0.6 GROUP BY 1), j AS (SELECT sc.*, ids, build_mode = 'production' AND k % 3 <> 0 AND k % 5 <> 0 AS strict FROM sc LEFT JOIN u USING (scene_id)) SELECT scene_id, CASE WHEN strict THEN coalesce(ids, '') ELSE '' END AS uncovered, NOT strict OR ids IS NULL AS passed FROM j", "images")
def background_gate(spark, d):
    scenes = _scenes(spark, d).withColumns({"clean_plate": F.col("k") % 3 == 0, "holes": F.col("k") % 5 == 0})
    return V.background_gate(scenes, _objects(spark, d), 0.6).select("scene_id", F.array_join("uncovered", ",").alias("uncovered"), "passed")


@R.query(f"WITH {SCENES}, {OBJECTS}, f AS (SELECT scene_id, instance_id, masks > 0 AS reviewable, CASE WHEN masks > 0 AND state <> 'rejected' THEN list_filter([CASE WHEN state <> 'approved' THEN instance_id || ': state=' || state END, CASE WHEN masks < 3 THEN instance_id || ': ' || masks::VARCHAR || ' masks (< 3)' END, CASE WHEN movable AND coverage < 0.5 THEN instance_id || ': background' END], lambda x: x IS NOT NULL) ELSE [] END AS f FROM ob) SELECT scene_id, CASE WHEN bool_or(reviewable) THEN array_to_string(flatten(list(f ORDER BY instance_id)), ';') ELSE 'no masked object' END AS failures FROM f GROUP BY 1", "images")
def approve_segmentation(spark, d):
    objects = _objects(spark, d)
    found = V.approve_segmentation(objects.drop("masks"), objects.where("masks > 0"), 3, 0.5)
    return found.select("scene_id", F.array_join("failures", ";").alias("failures"))


@R.query(f"WITH {SCENES}, {OBJECTS} SELECT scene_id, instance_id, CASE WHEN masks = 4 THEN 'approved' ELSE state END AS state, CASE WHEN masks = 4 AND movable THEN 1.0 ELSE coverage END AS coverage FROM ob", "images")
def apply_reviews(spark, d):
    objects = _objects(spark, d)
    decisions = objects.where("masks = 4").select("scene_id", "instance_id", F.lit("approved").alias("state"), F.when(F.col("movable"), 1.0).alias("coverage"))
    return rounded(V.apply_reviews(objects, decisions).select("scene_id", "instance_id", "state", "coverage"))


@R.query("SELECT concat('c', image_id) AS scene_id, array_to_string(list_filter([CASE WHEN image_id % 4 = 3 THEN 'modality' END, CASE WHEN image_id % 5 = 4 THEN 'held_out_ratio' END, CASE WHEN image_id % 3 < 1 THEN 'min_views_per_object' END, CASE WHEN image_id % 6 = 0 THEN 'simplify_ratio' END], lambda x: x IS NOT NULL), ',') AS problems FROM images", "images")
def scene_config_checks(spark, d):
    k = F.col("image_id")
    rows = view(spark, d, "images").select(F.concat(F.lit("c"), k.cast("string")).alias("scene_id"), F.element_at(F.array(*map(F.lit, ("rgb", "rgbd", "lidar", "sonar"))), (k % 4 + 1).cast("int")).alias("modality"), (k % 5 / 4.0).alias("held_out_ratio"), (k % 3).alias("min_views_per_object"), F.lit(0.1).alias("voxel_size_m"), (k % 6 / 5.0).alias("simplify_ratio"), F.lit("Z").alias("up_axis"), F.lit(1.0).alias("meters_per_unit"))
    return V.scene_config_checks(rows).select("scene_id", F.array_join("problems", ",").alias("problems"))


@R.query("WITH e AS (SELECT scene_id, 'masks' AS stage FROM mask_pixels UNION SELECT scene_id, 'poses' FROM images UNION SELECT scene_id, name FROM checks WHERE passed) SELECT scene_id, array_to_string(list_sort(list(DISTINCT stage)), ',') AS stages FROM e GROUP BY 1", "mask_pixels", "images", "checks")
def pipeline_progress(spark, d):
    stage = lambda df, name: df.select("scene_id", F.lit(name).alias("stage"))
    checks = view(spark, d, "checks").where("passed").select("scene_id", F.col("name").alias("stage"))
    found = V.pipeline_progress(stage(view(spark, d, "mask_pixels"), "masks"), stage(view(spark, d, "images"), "poses"), checks)
    return found.select("scene_id", F.array_join("stages", ",").alias("stages"))


@R.query("WITH q AS (SELECT scene_id, r % 8 AS part, count(*) AS n, " + ", ".join(f"quantile_cont({c}, [0.1, 0.25, 0.75, 0.9]) AS q{c}" for c in "xyz") + " FROM points GROUP BY ALL), m AS (SELECT p.scene_id, p.r % 8 AS part, point_id, n, " + " AND ".join(f"{c} BETWEEN q{c}[2] AND q{c}[3]" for c in "xyz") + " AS half, " + " AND ".join(f"{c} BETWEEN q{c}[1] AND q{c}[4]" for c in "xyz") + " AS wide FROM points p JOIN q ON p.scene_id = q.scene_id AND p.r % 8 = q.part), c AS (SELECT scene_id, part, count(*) FILTER (half) AS h, count(*) FILTER (wide) AS w FROM m GROUP BY ALL) SELECT scene_id, part, point_id FROM m JOIN c USING (scene_id, part) WHERE CASE WHEN n >= 32 AND h >= 16 THEN half WHEN n >= 32 AND w >= 8 THEN wide ELSE true END", "points")
def dense_core(spark, d):
    return V.dense_core(view(spark, d, "points").withColumn("part", F.col("r") % 8), ["scene_id", "part"]).select("scene_id", "part", "point_id")


@R.query("WITH m AS (SELECT scene_id, instance_id, count(DISTINCT frame) AS masks FROM mask_pixels GROUP BY ALL) SELECT scene_id, instance_id, masks FROM m WHERE instance_id <> 'i2'", "mask_pixels")
def review_instances(spark, d):
    pixels = view(spark, d, "mask_pixels")
    objects = pixels.select("scene_id", "instance_id").distinct().withColumn("merged_into", F.when(F.col("instance_id") == "i2", "i1"))
    return K.review_instances(objects, pixels).select("scene_id", "instance_id", "masks")


@R.query("SELECT scene_id, class_name AS slug, class_name || '_' || lpad((max(ordinal % 50) + 1)::VARCHAR, 3, '0') AS next_id FROM detections GROUP BY scene_id, class_name", "detections")
def next_instance_id(spark, d):
    rows = view(spark, d, "detections").select("scene_id", "class_name", F.format_string("%s_%03d", "class_name", F.col("ordinal") % 50).alias("instance_id"))
    return K.next_instance_id(rows, F.col("class_name"))
