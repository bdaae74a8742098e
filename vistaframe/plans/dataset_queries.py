"""Queries over frames and datasets, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaframe.functions import names as N
from vistaframe.operators import dataset as D
from vistaframe.plans.helpers import Registry
from vistaframe.sources.fixtures import view

R = Registry()

CHECKED = "c AS (SELECT *, CASE WHEN sharpness < 60 THEN 'blur' WHEN features < 300 THEN 'features' END AS reason FROM frames)"


def _checked(spark, d):
    return D.frame_qc(view(spark, d, "frames"), 60.0, 300)


@R.query(f"WITH {CHECKED} SELECT frame_id, reason FROM c", "frames")
def frame_qc(spark, d):
    return _checked(spark, d).select("frame_id", "reason")


@R.query("SELECT frame_id FROM frames WHERE frame_id % 3 = 0", "frames")
def stride_filter(spark, d):
    return D.stride_filter(view(spark, d, "frames"), 3, "frame_id").select("frame_id")


@R.query(f"WITH {CHECKED} SELECT session, count(*) AS considered, count(*) FILTER (reason IS NULL) AS kept, count(*) FILTER (reason = 'blur') AS rejected_blur, count(*) FILTER (reason = 'features') AS rejected_features FROM c GROUP BY 1", "frames")
def frame_qc_summary(spark, d):
    return D.frame_qc_summary(_checked(spark, d), "session")


@R.query(f"WITH {CHECKED}, s AS (SELECT session, frame_id, row_number() OVER (PARTITION BY session ORDER BY path) AS saved FROM c WHERE reason IS NULL) SELECT session, frame_id, saved FROM s WHERE saved <= 20", "frames")
def saved_ordinal(spark, d):
    return D.saved_ordinal(_checked(spark, d), "session", "path", 20).select("session", "frame_id", "saved")


@R.query(f"WITH {CHECKED}, s AS (SELECT session, frame_id, row_number() OVER (PARTITION BY session ORDER BY path) AS saved FROM c WHERE reason IS NULL) SELECT session, frame_id FROM s WHERE (saved - 1) % 4 = 0", "frames")
def keyframe_subsample(spark, d):
    return D.keyframe_subsample(D.saved_ordinal(_checked(spark, d), "session", "path"), 4).select("session", "frame_id")


@R.query("SELECT scene_id, image_id FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY name) - 1 AS pos FROM images) WHERE pos % 3 = 0", "images")
def held_out_views(spark, d):
    return D.held_out_views(view(spark, d, "images"), 0.3).select("scene_id", "image_id")


@R.query("WITH s AS (SELECT session, row_number() OVER (ORDER BY sha256('7:' || session), session) AS rk, count(*) OVER () AS n FROM (SELECT DISTINCT session FROM frames)) SELECT frame_id, CASE WHEN rk <= greatest(1, CAST(floor(n * 0.2) AS BIGINT)) THEN 'val' ELSE 'train' END AS split FROM frames JOIN s USING (session)", "frames")
def assign_split(spark, d):
    return D.assign_split(view(spark, d, "frames"), ratio=0.2, seed=7).select("frame_id", "split")


@R.query("SELECT frame_id, CASE WHEN session IN ('src1', 'src3') THEN 'val' ELSE 'train' END AS split FROM frames", "frames")
def assign_split_named(spark, d):
    return D.assign_split(view(spark, d, "frames"), val_sessions=["src1", "src3"]).select("frame_id", "split")


@R.query("WITH p AS (SELECT path, row_number() OVER (ORDER BY sha256('5:' || path), path) AS rk, count(*) OVER () AS n FROM frames) SELECT frame_id, CASE WHEN rk <= greatest(1, CAST(floor(n * 0.1) AS BIGINT)) THEN 'val' ELSE 'train' END AS split FROM frames JOIN p USING (path)", "frames")
def assign_split_frames(spark, d):
    return D.assign_split(view(spark, d, "frames"), "frame", ratio=0.1, seed=5).select("frame_id", "split")


@R.query("WITH i AS (SELECT image_id, regexp_replace(name, '\\.[^.]*$', '') AS key FROM images), l AS (SELECT DISTINCT key AS label_key FROM i WHERE image_id % 3 <> 0) SELECT i.image_id, coalesce(a.label_key, b.label_key) AS label_key FROM i LEFT JOIN l a ON a.label_key = i.key LEFT JOIN l b ON i.image_id >= 1 AND b.label_key = 'frame_' || lpad(CAST(i.image_id - 1 AS VARCHAR), 6, '0')", "images")
def resolve_labels(spark, d):
    images = view(spark, d, "images").select("image_id", N.stem(F.col("name")).alias("key"), F.col("image_id").alias("index"))
    labels = images.where("image_id % 3 <> 0").select(F.col("key").alias("label_key"))
    return D.resolve_labels(images, labels).select("image_id", "label_key")


@R.query("WITH i AS (SELECT scene_id, image_id, name, regexp_replace(name, '\\.[^.]*$', '') AS stem FROM images), f AS (SELECT scene_id, CASE WHEN image_id % 4 = 0 THEN stem || '.png' WHEN image_id % 4 = 1 THEN stem || '_mask.png' ELSE name END AS path FROM i WHERE image_id % 4 < 3 UNION ALL SELECT scene_id, stem || '.png' FROM i WHERE image_id % 8 = 2) SELECT i.scene_id, i.image_id, coalesce(a.path, b.path, c.path) AS path FROM i LEFT JOIN f a ON a.scene_id = i.scene_id AND a.path = i.stem || '.png' LEFT JOIN f b ON b.scene_id = i.scene_id AND b.path = i.name LEFT JOIN f c ON c.scene_id = i.scene_id AND c.path = i.stem || '_mask.png'", "images")
def resolve_masks(spark, d):
    i = view(spark, d, "images").select("scene_id", "image_id", "name", N.stem(F.col("name")).alias("stem"))
    png, other, name = F.concat("stem", F.lit(".png")), F.concat("stem", F.lit("_mask.png")), F.col("name")
    files = i.where("image_id % 4 < 3").select("scene_id", F.when(F.col("image_id") % 4 == 0, png).when(F.col("image_id") % 4 == 1, other).otherwise(name).alias("path"))
    files = files.unionByName(i.where("image_id % 8 = 2").select("scene_id", png.alias("path")))
    return D.resolve_by_priority(i, files, [png, name, other], ["scene_id"]).select("scene_id", "image_id", "path")


@R.query("SELECT split, name, max(origin) AS origin FROM (SELECT CASE WHEN frame_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, 'f' || (frame_id % 400)::VARCHAR AS name, 0 AS origin FROM frames WHERE frame_id < 300 UNION ALL SELECT 'train', 'f' || (frame_id % 400)::VARCHAR, 1 FROM frames WHERE frame_id >= 300 AND frame_id % 7 <> 0) GROUP BY ALL", "frames")
def mixed_dataset(spark, d):
    f = view(spark, d, "frames")
    name = F.concat(F.lit("f"), (F.col("frame_id") % 400).cast("string")).alias("name")
    real = f.where("frame_id < 300").select(F.when(F.col("frame_id") % 5 == 0, "val").otherwise("train").alias("split"), name, F.lit(0).alias("origin"))
    synthetic = f.where("frame_id >= 300").select(F.when(F.col("frame_id") % 7 == 0, "val").otherwise("train").alias("split"), name, F.lit(1).alias("origin"))
    return D.mixed_dataset(real, synthetic)
