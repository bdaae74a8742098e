"""Queries over lifted labels, reports, imports and datasets, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaframe.functions import names as N
from vistaframe.operators import dataset as D
from vistaframe.operators import lift as L
from vistaframe.operators import masks as K
from vistaframe.operators import meshes as H
from vistaframe.operators import quality as Q
from vistaframe.operators import reports as P
from vistaframe.operators.cameras import poses_with_cameras
from vistaframe.plans.box_queries import FIT, SEEN, VIEWS, level, merged
from vistaframe.plans.camera_queries import M
from vistaframe.plans.helpers import Registry, rounded
from vistaframe.plans.quality_queries import SUMMARY, _summary
from vistaframe.plans.scene_queries import VOTES, _mesh, _votes
from vistaframe.sources.fixtures import view

R = Registry()


@R.query("SELECT scene_id, gaussian_id FROM gaussians WHERE opacity >= 0.3", "gaussians")
def opaque_points(spark, d):
    return L.opaque_points(view(spark, d, "gaussians")).select("scene_id", "gaussian_id")


@R.query("SELECT scene_id, gaussian_id, round(sx + sy + sz, 6) AS packed FROM gaussians WHERE opacity >= 0.5", "gaussians")
def filter_packed(spark, d):
    g = view(spark, d, "gaussians").withColumn("sh", F.array("sx", "sy", "sz"))
    kept = L.filter_packed(g, F.col("opacity") >= 0.5, 3)
    return rounded(kept.select("scene_id", "gaussian_id", F.aggregate("sh", F.lit(0.0), lambda s, x: s + x).alias("packed")))


@R.query("SELECT instance_id FROM objects WHERE movable AND review_state = 'approved'", "objects")
def movable_approved(spark, d):
    return P.movable_approved(view(spark, d, "objects")).select("instance_id")


BRIGHT = "(u * 13 + v * 29 + frame * 7) % 256"


@R.query(f"SELECT scene_id, instance_id, frame, count(*) AS pixels FROM mask_pixels WHERE {BRIGHT} > 127 GROUP BY ALL", "mask_pixels")
def binarize_masks(spark, d):
    rows = K.binarize_masks(view(spark, d, "mask_pixels").withColumn("value", F.expr(BRIGHT)))
    return rows.groupBy("scene_id", "instance_id", "frame").agg(F.count(F.lit(1)).alias("pixels"))


@R.query("SELECT ordinal, CASE WHEN length(class_name) % 2 = 0 THEN 1 ELSE 2 END AS class_id FROM detections WHERE length(class_name) > 4", "detections")
def alias_classes(spark, d):
    det = view(spark, d, "detections")
    named = det.select("class_name").distinct().where(F.length("class_name") > 4)
    own = named.select(F.upper("class_name").alias("alias"), F.when(F.length("class_name") % 2 == 0, 1).otherwise(2).alias("class_id"), F.lit(1).alias("ordinal"))
    later = named.select(F.concat(F.lit(" "), "class_name").alias("alias"), F.lit(99).alias("class_id"), F.lit(2).alias("ordinal"))
    return L.alias_classes(det, later.unionByName(own)).select("ordinal", "class_id")


@R.query("SELECT scene_id, image_id, CASE WHEN image_id % 2 = 0 THEN round(tx, 6) END AS tx FROM images WHERE image_id % 3 = 0", "images")
def camera_for_held_out(spark, d):
    images = view(spark, d, "images")
    held = images.where("image_id % 3 = 0").select("scene_id", "name", "image_id")
    return rounded(L.camera_for_held_out(held, images.where("image_id % 2 = 0"), ["scene_id", "name"]).select("scene_id", "image_id", "tx"))


@R.query("WITH s AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY name) - 1 AS pos FROM images), l AS (SELECT * FROM s SEMI JOIN (SELECT * FROM labels2d WHERE class_id = 1 AND ordinal < 2) b ON s.scene_id = b.scene_id AND s.image_id = b.image_id WHERE pos % 2 = 0) SELECT scene_id, image_id FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY name) AS rk FROM l) WHERE rk <= 5", "images", "labels2d")
def debug_frames(spark, d):
    labels = view(spark, d, "labels2d").where("class_id = 1 AND ordinal < 2")
    return L.debug_frames(view(spark, d, "images"), labels, 2, 5).select("scene_id", "image_id")


@R.query("SELECT scene_id, concat('i', point_id % 3) AS instance_id, point_id, CASE WHEN point_id % 4 = 0 THEN r + 11 WHEN point_id % 5 <> 0 THEN r ELSE 180 END AS r, CASE WHEN point_id % 4 = 0 OR point_id % 5 <> 0 THEN g ELSE 180 END AS g FROM points WHERE point_id % 2 = 0", "points")
def point_colors(spark, d):
    p = view(spark, d, "points").withColumn("instance_id", F.concat(F.lit("i"), F.col("point_id") % 3))
    key = ["scene_id", "instance_id", "point_id"]
    seen = p.where("point_id % 4 = 0")
    samples = seen.select(*key, (F.col("r") + 10).alias("r"), "g", "b").unionByName(seen.select(*key, (F.col("r") + 13).alias("r"), "g", "b"))
    return L.point_colors(p.where("point_id % 2 = 0").select(key), samples, p.where("point_id % 5 <> 0")).select(*key, "r", "g")


@R.query("SELECT scene_id, image_id, CASE image_id % 4 WHEN 0 THEN regexp_replace(name, '\\.[^.]*$', '.jpeg') WHEN 1 THEN regexp_replace(name, '\\.[^.]*$', '.png') WHEN 3 THEN name END AS path FROM images", "images")
def resolve_renders(spark, d):
    i = view(spark, d, "images").select("scene_id", "image_id", "name")
    stem = N.stem(F.col("name"))
    ends = F.when(F.col("image_id") % 4 == 0, F.array(F.lit(".jpeg"))).when(F.col("image_id") % 4 == 1, F.array(F.lit(".jpeg"), F.lit(".png"))).when(F.col("image_id") % 4 == 3, F.array(F.lit(".jpg"), F.lit(".png"))).otherwise(F.array().cast("array<string>"))
    renders = i.select("scene_id", F.explode(F.transform(ends, lambda e: F.concat(stem, e))).alias("path"))
    return D.resolve_renders(i, renders, ["scene_id"]).select("scene_id", "image_id", "path")


@R.query("SELECT scene_id, image_id, CASE image_id % 3 WHEN 0 THEN regexp_replace(name, '\\.[^.]*$', '.png') WHEN 1 THEN name END AS path FROM images", "images")
def resolve_clean_plates(spark, d):
    i = view(spark, d, "images").select("scene_id", "image_id", "name")
    stem = N.stem(F.col("name"))
    plates = i.where("image_id % 3 <> 2").select("scene_id", F.when(F.col("image_id") % 3 == 0, F.concat(stem, F.lit(".png"))).otherwise(F.col("name")).alias("path"))
    return D.resolve_clean_plates(i, plates, ["scene_id"]).select("scene_id", "image_id", "path")


def _by_trial(df):
    return df.withColumn("scene_id", F.concat_ws("_", "scene_id", "trial")).drop("trial")


REPORTED = f"""{SUMMARY}, cl AS (SELECT concat('s', o_custkey % 10, '_', o_custkey % 12) AS scene_id, count(*) AS n, count(*) FILTER (o_orderkey % 5 <> 0) AS kept, count(*) FILTER (o_orderkey % 5 = 0 AND o_orderkey % 2 = 0) AS op, count(*) FILTER (o_orderkey % 5 = 0 AND o_orderkey % 2 <> 0) AS ou FROM orders GROUP BY 1),
q AS (SELECT concat(scene_id, '_', trial) AS scene_id, trial, evaluated, mean_psnr, mean_ssim, mean_lpips, trial % 8 AS failed, CASE WHEN trial <> 7 THEN trial * 1e0 END AS reg, 100*(0.45*least(greatest(mean_ssim,0),1)+0.35*least(greatest(1-mean_lpips,0),1)+0.2*least(greatest(mean_psnr/40,0),1)) AS app FROM s),
rep AS (SELECT q.*, kept AS gaussian_count, op / n AS opacity, ou / n AS outlier, CASE WHEN reg > 5 THEN 10e0 ELSE 0e0 END AS far, least(30e0, 5e0 * failed) AS chk FROM q LEFT JOIN cl USING (scene_id))"""


def _report(spark, d):
    photo = _by_trial(_summary(spark, d).withColumn("expected", F.col("evaluated") + 1))
    orders = view(spark, d, "checks").sparkSession.read.parquet(f"{d}/orders.parquet")
    lost, even = F.col("o_orderkey") % 5 == 0, F.col("o_orderkey") % 2 == 0
    cleanup = orders.groupBy(F.concat(F.lit("s"), F.col("o_custkey") % 10, F.lit("_"), F.col("o_custkey") % 12).alias("scene_id")).agg(F.count(F.lit(1)).alias("input"), F.count_if(~lost).alias("kept"), F.count_if(lost & even).alias("removed_opacity"), F.count_if(lost & ~even).alias("removed_outlier"))
    trial = F.regexp_extract("scene_id", "_(\\d+)$", 1).cast("int")
    builds = photo.select("scene_id", (trial % 2 == 0).alias("usable"), (trial % 8).alias("failed"), F.when(trial != 7, trial * 1.0).alias("registration_median"))
    return P.scene_quality_report(photo.select("scene_id"), photo, cleanup, builds, 5.0)


@R.query(f"WITH {REPORTED} SELECT scene_id, round_even(round_even(greatest(0, app - far - chk), 3), 1) AS quality_score, round_even(round_even(app, 3), 1) AS appearance_score, far AS registration_penalty, chk AS failed_check_penalty, evaluated AS evaluated_views, evaluated + 1 AS expected_views, gaussian_count, round(opacity, 6) AS removed_opacity_fraction, round(outlier, 6) AS removed_outlier_fraction, trial % 2 = 0 AS usable FROM rep", "view_metrics")
def scene_quality_report(spark, d):
    found = _report(spark, d).select("scene_id", F.bround("quality_score", 1).alias("quality_score"), F.bround("appearance_score", 1).alias("appearance_score"), "registration_penalty", "failed_check_penalty", "evaluated_views", "expected_views", "gaussian_count", *[F.round(f"removed_{r}_fraction", 6).alias(f"removed_{r}_fraction") for r in ("opacity", "outlier")], "usable")
    return found


@R.query(f"WITH {REPORTED} SELECT scene_id AS trial_id, CASE WHEN trial % 2 = 0 THEN round_even(round_even(greatest(0, app - far - chk), 3), 1) END AS quality_score, CASE WHEN trial % 2 = 0 THEN round(mean_ssim, 6) END AS mean_ssim, CASE WHEN trial % 2 = 0 THEN gaussian_count END AS gaussian_count FROM rep", "view_metrics")
def trial_metrics(spark, d):
    reports = _report(spark, d).withColumnRenamed("scene_id", "trial_id")
    trials = reports.select("trial_id", F.lit(0.0).alias("quality_score"))
    return P.trial_metrics(trials, reports.where("usable")).select("trial_id", F.bround("quality_score", 1).alias("quality_score"), F.round("mean_ssim", 6).alias("mean_ssim"), "gaussian_count")


def _assets(spark, d):
    """Objects with files, meshes and physics, some of which lack something."""
    o = view(spark, d, "objects")
    files = F.map_from_arrays(F.array(*[F.lit(x) for x in (*P.ASSET_FILES, "pbr_roughness")]), F.array(F.col("k") % 5 != 0, F.col("k") % 7 != 0, F.lit(True), F.col("k") % 2 == 0))
    keys = F.when(F.col("size") % 3 == 0, F.array(F.lit("mass_kg"), F.lit("friction"))).otherwise(F.array(*[F.lit(x) for x in P.ASSET_PHYSICS]))
    return o.select("*", files.alias("files"), F.map_from_arrays(keys, F.transform(keys, lambda _: F.lit("1"))).alias("physics"), (F.col("size") % 2 == 0).alias("physics_approved"), F.when(F.col("k") % 5 != 0, F.col("size")).alias("vertices"), F.when(F.col("size") % 4 != 0, F.col("size")).alias("uvs"), (F.col("k") % 9 != 0).alias("watertight"), F.when(F.col("k") % 7 != 0, F.col("size") * 10).alias("collider_faces"))


@R.query("""WITH o AS (SELECT *, scene_id < 's5' AS required FROM objects WHERE movable AND review_state = 'approved'),
c AS (SELECT scene_id, instance_id, required, 'object_files' AS name, k % 5 <> 0 AND k % 7 <> 0 AND k % 2 = 0 AS passed, array_to_string(list_filter([CASE WHEN k % 7 = 0 THEN 'collision_mesh' END, CASE WHEN k % 2 <> 0 THEN 'pbr_roughness' END, CASE WHEN k % 5 = 0 THEN 'render_mesh' END], lambda x: x IS NOT NULL), ',') AS missing FROM o
UNION ALL SELECT scene_id, instance_id, required, 'object_visual_mesh', k % 9 <> 0 AND size % 4 <> 0, '' FROM o WHERE k % 5 <> 0
UNION ALL SELECT scene_id, instance_id, required, 'object_collider', size * 10 <= 300, '' FROM o WHERE k % 7 <> 0
UNION ALL SELECT scene_id, instance_id, required, 'object_physics', size % 3 <> 0 AND (NOT required OR size % 2 = 0), CASE WHEN size % 3 = 0 THEN 'diagonal_inertia_kg_m2,restitution' ELSE '' END FROM o
UNION ALL SELECT scene_id, instance_id, required, 'object_background', coverage >= 0.5 OR scene_id = 's1', '' FROM o) SELECT * FROM c""", "objects")
def object_checks(spark, d):
    o = _assets(spark, d)
    scenes = o.select("scene_id").distinct().select("scene_id", F.when(F.col("scene_id") < "s5", "production").otherwise("preview").alias("build_mode"), (F.col("scene_id") == "s1").alias("clean_plate"))
    return P.object_checks(scenes, o, 300, 0.5).withColumn("missing", F.array_join("missing", ","))


@R.query("SELECT scene_id, instance_id, CASE WHEN k % 5 <> 0 AND k % 7 <> 0 AND size % 3 <> 0 THEN 'approved' END AS state, (CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN size % 3 = 0 THEN 2 ELSE 0 END)::INT AS failures FROM objects", "objects")
def approve_asset(spark, d):
    return P.approve_asset(_assets(spark, d), "me").select("scene_id", "instance_id", "state", F.size("failures").alias("failures"))


@R.query("SELECT DISTINCT scene_id, 'lighting' AS gate, CASE WHEN scene_id IN (SELECT scene_id FROM artifacts WHERE artifact_id LIKE '%7') THEN 'approved' END AS state FROM artifacts", "artifacts")
def approve_lighting(spark, d):
    a = view(spark, d, "artifacts")
    named = a.withColumn("artifact_id", F.when(F.col("artifact_id").like("%7"), "scene_lighting").otherwise(F.col("artifact_id")))
    return P.approve_lighting(named, a.select("scene_id").distinct(), "me").select("scene_id", "gate", "state")


@R.query("SELECT DISTINCT scene_id FROM artifacts WHERE scene_id IN (SELECT scene_id FROM artifacts WHERE artifact_id LIKE '%3' AND file_exists) AND scene_id IN (SELECT scene_id FROM mask_pixels WHERE instance_id = 'i2' AND frame < 15)", "artifacts", "mask_pixels")
def masks_ready(spark, d):
    a = view(spark, d, "artifacts")
    named = a.withColumn("artifact_id", F.when(F.col("artifact_id").like("%3"), "instance_masks").otherwise(F.col("artifact_id")))
    return P.masks_ready(a.select("scene_id").distinct(), named, view(spark, d, "mask_pixels").where("instance_id = 'i2' AND frame < 15"))


@R.query("SELECT class_name, scene_id, CASE WHEN scene_id = 's4' THEN 'given' ELSE path END AS path FROM (SELECT class_name, scene_id, arg_max(concat('run', ordinal), (confidence, concat('run', ordinal))) AS path FROM detections GROUP BY ALL)", "detections")
def latest_run(spark, d):
    det = view(spark, d, "detections").select("scene_id", "class_name", F.concat(F.lit("run"), "ordinal").alias("path"), F.col("confidence").alias("modified"))
    given = det.where("scene_id = 's4'").select("scene_id", "class_name").distinct().withColumn("path", F.lit("given"))
    return P.latest_run(det, ["scene_id", "class_name"], given)


@R.query("""WITH f AS (SELECT scene_id, instance_id, count(DISTINCT frame) AS frames FROM mask_pixels GROUP BY ALL), o AS (SELECT scene_id, concat('i', k % 9) AS instance_id, min(k) AS k FROM objects GROUP BY ALL)
SELECT coalesce(o.scene_id, f.scene_id) AS scene_id, coalesce(o.instance_id, f.instance_id) AS instance_id, CASE WHEN f.frames IS NOT NULL THEN 'chair' ELSE 'old' END AS class_name, CASE WHEN f.frames IS NOT NULL THEN 'pending' ELSE 'approved' END AS review_state, CASE WHEN f.frames < 18 THEN concat('Only ', f.frames, ' valid masks; need 18') ELSE '' END AS warnings FROM o FULL JOIN f ON o.scene_id = f.scene_id AND o.instance_id = f.instance_id""", "objects", "mask_pixels")
def import_masks(spark, d):
    pixels = view(spark, d, "mask_pixels")
    old = view(spark, d, "objects").select("scene_id", F.concat(F.lit("i"), F.col("k") % 9).alias("instance_id")).distinct()
    old = old.select("*", F.lit("Old").alias("display_name"), F.lit("old").alias("class_name"), F.lit("approved").alias("review_state"), F.array().cast("array<string>").alias("warnings"))
    tracks = pixels.select("scene_id", "instance_id").distinct().withColumn("class_name", F.lit("chair"))
    return K.import_masks(old, tracks, K.mask_report(pixels, 350), 18).select("scene_id", "instance_id", "class_name", "review_state", F.array_join("warnings", ";").alias("warnings"))


@R.query(f"WITH o AS (SELECT DISTINCT scene_id, instance_id FROM mask_pixels), c AS (SELECT * FROM mask_pixels WHERE instance_id = 'i3' AND frame < 5), p AS (SELECT scene_id, instance_id, frame, u, v FROM mask_pixels WHERE NOT (instance_id = 'i3' AND frame < 5) UNION ALL SELECT scene_id, instance_id, frame, u, v FROM c WHERE {BRIGHT} > 127), n AS (SELECT scene_id, instance_id, count(*) AS pixels FROM p GROUP BY ALL) SELECT o.scene_id, o.instance_id, coalesce(pixels, 0) AS pixels, CASE WHEN EXISTS (SELECT 1 FROM c WHERE c.scene_id = o.scene_id AND c.instance_id = o.instance_id) THEN 'pending' ELSE 'approved' END AS review_state FROM o LEFT JOIN n USING (scene_id, instance_id)", "mask_pixels")
def import_corrected_masks(spark, d):
    pixels = view(spark, d, "mask_pixels")
    objects = pixels.select("scene_id", "instance_id").distinct().withColumn("review_state", F.lit("approved"))
    corrected = pixels.where("instance_id = 'i3' AND frame < 5").withColumn("value", F.expr(BRIGHT))
    new, reviewed = K.import_corrected_masks(pixels, objects, corrected)
    counts = new.groupBy("scene_id", "instance_id").agg(F.count(F.lit(1)).alias("pixels"))
    return reviewed.join(counts, ["scene_id", "instance_id"], "left").select("scene_id", "instance_id", F.coalesce("pixels", F.lit(0)).alias("pixels"), "review_state")


@R.query("SELECT scene_id, review_state, count(*) AS n, min(k) AS first FROM (SELECT scene_id, k, CASE WHEN k % 3 = 0 THEN 'new' ELSE review_state END AS review_state FROM objects WHERE k % 2 = 0 OR k % 3 = 0) GROUP BY ALL", "objects")
def upsert_objects(spark, d):
    o = view(spark, d, "objects").select("scene_id", "instance_id", "k", "review_state")
    merged = Q.upsert(o.where("k % 2 = 0"), o.where("k % 3 = 0").withColumn("review_state", F.lit("new")), ["scene_id", "instance_id"], "k")
    return merged.groupBy("scene_id", "review_state").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first"))


@R.query("SELECT instance_id AS artifact_id, CASE WHEN k % 3 = 0 THEN k + 1000000 ELSE k END AS ordinal FROM objects WHERE k % 2 = 0 OR k % 3 = 0", "objects")
def upsert_artifacts(spark, d):
    o = view(spark, d, "objects").select(F.col("instance_id").alias("artifact_id"), F.col("k").cast("long").alias("ordinal"))
    new = o.where("ordinal % 3 = 0").withColumn("ordinal", F.col("ordinal") + 1_000_000)
    return Q.upsert(o.where("ordinal % 2 = 0"), new, ["artifact_id"], "ordinal", keeps_place=False)


@R.query("SELECT frame_id, CASE WHEN frame_id % 2 = 0 THEN 'train' ELSE 'val' END AS split FROM frames WHERE frame_id % 6 IN (0, 1, 2)", "frames")
def attach_real_val(spark, d):
    f = view(spark, d, "frames").select("frame_id", F.when(F.col("frame_id") % 2 == 0, "train").otherwise("val").alias("split"))
    return D.attach_real_val(f.where("frame_id % 6 IN (0, 2, 3)"), f.where("frame_id % 6 IN (1, 4)"))


LABELLED = "l AS (SELECT replace(regexp_replace(path, '\\.[^./]*$', ''), '/', '_') AS label_key, o AS ordinal, o + 1 AS class_id FROM frames CROSS JOIN range(2) t(o) WHERE frame_id % 3 <> 0)"


@R.query(f"WITH {LABELLED}, i AS (SELECT *, replace(regexp_replace(path, '\\.[^./]*$', ''), '/', '_') AS key FROM frames) SELECT CASE WHEN session IN ('src1', 'src3') THEN 'val' ELSE 'train' END AS split, key AS label_key, CASE WHEN frame_id % 4 = 0 THEN concat('capture/', key) ELSE path END AS path, l.ordinal::INT AS ordinal, l.class_id::INT AS class_id FROM i LEFT JOIN l ON i.key = l.label_key", "frames")
def real_dataset(spark, d):
    f = view(spark, d, "frames").select("frame_id", "session", "path", N.frame_label_key(F.col("path")).alias("key"), F.lit(None).cast("long").alias("index"))
    labels = f.where("frame_id % 3 <> 0").select(F.col("key").alias("label_key"), F.explode(F.array(F.lit(0), F.lit(1))).alias("ordinal"))
    labels = labels.select("*", (F.col("ordinal") + 1).alias("class_id"), *[F.lit(0.5).alias(c) for c in ("xc", "yc", "w", "h")])
    captures = f.where("frame_id % 4 = 0").select("key", F.concat(F.lit("capture/"), "key").alias("path"))
    return D.real_dataset(f, labels, captures, val_sessions=["src1", "src3"]).select("split", "label_key", "path", "ordinal", "class_id")


def _objects(spark, d):
    low = view(spark, d, "points").groupBy("scene_id").agg(*[(f(c) / 20 + (3.0 if c == "z" else 0.0)).alias(f"{n}_{c}") for f, n in ((F.min, "lo"), (F.max, "hi")) for c in "xyz"])
    return low.select("*", F.lit(7).alias("object_id"), F.lit(1).alias("class_id"))


SYNTHETIC = """b AS (SELECT scene_id, min(x)/20 AS lx, min(y)/20 AS ly, min(z)/20 + 3 AS lz, max(x)/20 AS hx, max(y)/20 AS hy, max(z)/20 + 3 AS hz FROM points GROUP BY 1),
rr AS (SELECT *, 1-2*(qy*qy+qz*qz) AS r0, 2*(qx*qy-qw*qz) AS r1, 2*(qx*qz+qw*qy) AS r2, 2*(qx*qy+qw*qz) AS r3, 1-2*(qx*qx+qz*qz) AS r4, 2*(qy*qz-qw*qx) AS r5, 2*(qx*qz-qw*qy) AS r6, 2*(qy*qz+qw*qx) AS r7, 1-2*(qx*qx+qy*qy) AS r8 FROM images JOIN cameras USING (scene_id, camera_id)),
cc AS (SELECT rr.scene_id, image_id, fx, fy, cx, cy, r0*x+r1*y+r2*z+tx AS a, r3*x+r4*y+r5*z+ty AS b, r6*x+r7*y+r8*z+tz AS c FROM rr JOIN (SELECT scene_id, CASE WHEN i%2=0 THEN lx ELSE hx END AS x, CASE WHEN i//2%2=0 THEN ly ELSE hy END AS y, CASE WHEN i//4=0 THEN lz ELSE hz END AS z FROM b CROSS JOIN range(8) t(i)) k USING (scene_id)),
gg AS (SELECT scene_id, image_id, bool_or(c <= 1e-4) AS behind, min(fx*a/(c+1e-12)+cx) AS u0, max(fx*a/(c+1e-12)+cx) AS u1, min(fy*b/(c+1e-12)+cy) AS v0, max(fy*b/(c+1e-12)+cy) AS v1 FROM cc GROUP BY ALL),
sl AS (SELECT scene_id, image_id, (least(greatest(u0,0),639)+least(greatest(u1,0),639))/2/640 AS xc, greatest((least(greatest(v1,0),479)-least(greatest(v0,0),479))/480,1e-6) AS h FROM gg WHERE NOT (behind OR u1 < 0 OR v1 < 0 OR u0 >= 640 OR v0 >= 480))"""


@R.query(f"WITH {SYNTHETIC} SELECT scene_id, image_id, 7 AS object_id, 1 AS class_id, round(xc, 6) AS xc, round(h, 6) AS h FROM sl", "points", "images", "cameras")
def synthetic_labels(spark, d):
    poses = poses_with_cameras(view(spark, d, "images"), view(spark, d, "cameras"))
    return rounded(D.synthetic_labels(_objects(spark, d), poses).select("scene_id", "image_id", "object_id", "class_id", "xc", "h"))


@R.query(f"WITH {SYNTHETIC}, n AS (SELECT scene_id, image_id, printf('synth_%06d', row_number() OVER (ORDER BY scene_id, image_id) - 1) AS label_key FROM images) SELECT label_key, 'train' AS split, CASE WHEN sl.xc IS NOT NULL THEN 1 END AS class_id, round(xc, 6) AS xc FROM n LEFT JOIN sl USING (scene_id, image_id)", "points", "images", "cameras")
def synthetic_dataset(spark, d):
    images = view(spark, d, "images")
    labels = D.synthetic_labels(_objects(spark, d), poses_with_cameras(images, view(spark, d, "cameras")))
    found = D.synthetic_dataset(images.select("scene_id", "image_id", F.col("name").alias("path")), labels)
    return rounded(found.select("label_key", "split", "class_id", "xc"))


@R.query("WITH i AS (SELECT scene_id, frame, u, v, min(instance_id) AS value FROM mask_pixels GROUP BY ALL), m AS (SELECT DISTINCT scene_id, frame, u, v FROM mask_pixels WHERE instance_id = 'i2'), f AS (SELECT scene_id, frame, (row_number() OVER (PARTITION BY scene_id ORDER BY frame) - 1) % 4 = 0 AS held_out FROM (SELECT DISTINCT scene_id, frame FROM mask_pixels)), c AS (SELECT scene_id, frame, count(*) AS n FROM m GROUP BY ALL), k AS (SELECT i.scene_id, i.frame, count(*) FILTER (m.u IS NULL OR i.u % 2 = 0) AS kept, count(*) FILTER (m.u IS NOT NULL AND i.u % 2 = 0) AS plated FROM i LEFT JOIN m ON i.scene_id = m.scene_id AND i.frame = m.frame AND i.u = m.u AND i.v = m.v GROUP BY ALL) SELECT f.scene_id, f.frame, held_out, round(coalesce(n, 0) / 350e0, 6) AS masked, kept, plated FROM f LEFT JOIN c USING (scene_id, frame) JOIN k USING (scene_id, frame)", "mask_pixels")
def stage_training_set(spark, d):
    pixels = view(spark, d, "mask_pixels")
    image = pixels.groupBy("scene_id", "frame", "u", "v").agg(F.min("instance_id").alias("value"))
    plate = image.where("u % 2 = 0").withColumn("value", F.lit("plate"))
    images = pixels.select("scene_id", "frame").distinct().select("scene_id", "frame", F.format_string("%06d", "frame").alias("name"), F.lit(350).alias("frame_pixels"))
    frames, staged = D.stage_training_set(images, image, pixels.where("instance_id = 'i2'"), plate, 0.25)
    counts = staged.groupBy("scene_id", "frame").agg(F.count_if("keep").alias("kept"), F.count_if(F.col("value") == "plate").alias("plated"))
    return rounded(frames.select("scene_id", "frame", "held_out", "masked").join(counts, ["scene_id", "frame"]))


DEBUGGED = f"""{FIT},
bb AS (SELECT scene_id, image_id, ordinal, mx+(f0+f1)/2*fx_-(a0+a1)/2*fy_ AS bx, my+(f0+f1)/2*fy_+(a0+a1)/2*fx_ AS by_, mz+(u0+u1)/2 AS bz, fx_, fy_, greatest((f1-f0)/2,1e-3) AS hf, greatest((a1-a0)/2,1e-3) AS hr, greatest((u1-u0)/2,1e-3) AS hu FROM ax JOIN sp USING (scene_id, image_id, ordinal)),
kk AS (SELECT scene_id, image_id, ordinal, bx+ef*fx_-er*fy_ AS x, by_+ef*fy_+er*fx_ AS y, bz+eu AS z FROM (SELECT *, CASE WHEN i%2=0 THEN -hf ELSE hf END AS ef, CASE WHEN i//2%2=0 THEN -hr ELSE hr END AS er, CASE WHEN i//4=0 THEN -hu ELSE hu END AS eu FROM bb CROSS JOIN range(8) t(i))),
kp AS (SELECT kk.scene_id, kk.image_id, ordinal, fx, CASE WHEN model LIKE '%RADIAL' OR model = 'SIMPLE_PINHOLE' THEN fx ELSE fy END AS fy, cx, cy, r0*x+r1*y+r2*z+tx AS a, r3*x+r4*y+r5*z+ty AS b, r6*x+r7*y+r8*z+tz AS c FROM kk JOIN rot ON kk.scene_id = rot.scene_id AND kk.image_id = rot.image_id),
ks AS (SELECT scene_id, image_id, ordinal, bool_or(c <= 1e-4) AS behind, min(fx*a/(c+1e-12)+cx) AS u0, max(fx*a/(c+1e-12)+cx) AS u1, min(fy*b/(c+1e-12)+cy) AS v0, max(fy*b/(c+1e-12)+cy) AS v1 FROM kp GROUP BY ALL),
kb AS (SELECT scene_id, image_id, ordinal, NOT (behind OR u1 < 0 OR v1 < 0 OR u0 >= 640 OR v0 >= 480) AS ok, least(greatest(u0,0),639) AS x0, least(greatest(v0,0),479) AS y0, least(greatest(u1,0),639) AS x1, least(greatest(v1,0),479) AS y1 FROM ks),
np AS (SELECT scene_id, image_id, ordinal, count(*) AS points FROM inside GROUP BY ALL),
lb AS (SELECT scene_id, image_id, ordinal, class_id, 640*(xc-w/2) AS x0, 480*(yc-h/2) AS y0, 640*(xc+w/2) AS x1, 480*(yc+h/2) AS y1 FROM labels2d SEMI JOIN rot ON labels2d.scene_id = rot.scene_id AND labels2d.image_id = rot.image_id),
dbg AS (SELECT lb.scene_id, lb.image_id, lb.ordinal, lb.class_id, points, CASE WHEN points IS NOT NULL THEN CASE WHEN ok THEN greatest(least(lb.x1,kb.x1)-greatest(lb.x0,kb.x0),0)*greatest(least(lb.y1,kb.y1)-greatest(lb.y0,kb.y0),0) / greatest((lb.x1-lb.x0)*(lb.y1-lb.y0)+(kb.x1-kb.x0)*(kb.y1-kb.y0)-greatest(least(lb.x1,kb.x1)-greatest(lb.x0,kb.x0),0)*greatest(least(lb.y1,kb.y1)-greatest(lb.y0,kb.y0),0), 1e-9) ELSE 0 END END AS iou FROM lb LEFT JOIN np USING (scene_id, image_id, ordinal) LEFT JOIN kb USING (scene_id, image_id, ordinal))"""


def _lifted(spark, d):
    return L.lift_debug(*[view(spark, d, v) for v in VIEWS], inner=0.1)


@R.query(f"WITH {DEBUGGED} SELECT scene_id, image_id, ordinal, class_id, points, round(iou, 4) AS iou FROM dbg", *VIEWS)
def lift_debug(spark, d):
    return rounded(_lifted(spark, d), 4)


@R.query(f"WITH {DEBUGGED} SELECT scene_id, count(*) AS detections, count(DISTINCT image_id) AS frames, count(points) AS lifted, round(median(iou) FILTER (points IS NOT NULL), 4) AS median_iou, count(*) FILTER (points > 40) AS many_points FROM dbg GROUP BY 1", *VIEWS)
def lift_summary(spark, d):
    return rounded(P.lift_summary(_lifted(spark, d), 40), 4)


@R.query(f"""WITH RECURSIVE {SEEN}, {merged(2.0)},
mp AS (SELECT scene_id, class_id, merged AS object, ordinal, ox, oy, oz, unnest(px) AS x, unnest(py) AS y, unnest(pz) AS z FROM mo JOIN src USING (scene_id, class_id, ordinal)),
mm AS (SELECT scene_id, class_id, object, count(*) AS points, count(DISTINCT ordinal) AS observations, median(x) AS mx, median(y) AS my, median(z) AS mz, median(x)-avg(ox) AS vx, median(y)-avg(oy) AS vy, median(z)-avg(oz) AS vz FROM mp GROUP BY ALL),
ml AS (SELECT *, {level("vx")} AS fx_, {level("vy")} AS fy_ FROM mm),
mq AS (SELECT scene_id, class_id, object, {", ".join(f"quantile_cont({e}, {q}) AS {a}{k}" for a, e in (("f", "(x-mx)*fx_+(y-my)*fy_"), ("r", "(y-my)*fx_-(x-mx)*fy_"), ("u", "z-mz")) for k, q in ((0, 0.05), (1, 0.95)))} FROM mp JOIN ml USING (scene_id, class_id, object) GROUP BY ALL)
SELECT scene_id, class_id, object, round(mx+(f0+f1)/2*fx_-(r0+r1)/2*fy_, 4) AS cx, round(my+(f0+f1)/2*fy_+(r0+r1)/2*fx_, 4) AS cy, round(mz+(u0+u1)/2, 4) AS cz, {", ".join(f"round(greatest(({a}1-{a}0)/2, 1e-3), 4) AS half_{a}" for a in "fru")}, observations, points FROM ml JOIN mq USING (scene_id, class_id, object)""", *VIEWS)
def lift_scene(spark, d):
    found = L.lift_scene(*[view(spark, d, v) for v in VIEWS], distance=2.0, inner=0.1)
    return rounded(found.select("scene_id", "class_id", "object", "cx", "cy", "cz", "half_f", "half_r", "half_u", "observations", "points"), 4)


CORED = f"""{VOTES}, n AS (SELECT scene_id, instance_id, count(*) FILTER (votes >= 2) AS many, count(*) AS every FROM votes GROUP BY ALL),
ch AS (SELECT scene_id, instance_id, point_id, votes, x, y, z FROM votes JOIN n USING (scene_id, instance_id) JOIN points USING (scene_id, point_id) WHERE votes >= CASE WHEN many >= 16 THEN 2 WHEN every >= 8 THEN 1 END),
sq AS (SELECT scene_id, instance_id, count(*) AS cnt, {", ".join(f"quantile_cont({c}, {q}) AS {c}{n}" for c in "xyz" for q, n in ((0.1, 1), (0.25, 2), (0.75, 3), (0.9, 4)))} FROM ch GROUP BY ALL),
mk AS (SELECT ch.*, cnt, {" AND ".join(f"{c} BETWEEN {c}2 AND {c}3" for c in "xyz")} AS half, {" AND ".join(f"{c} BETWEEN {c}1 AND {c}4" for c in "xyz")} AS wide FROM ch JOIN sq USING (scene_id, instance_id)),
ct AS (SELECT scene_id, instance_id, count(*) FILTER (half) AS halves, count(*) FILTER (wide) AS wides FROM mk GROUP BY ALL)"""


@R.query(f"WITH {CORED} SELECT scene_id, instance_id, point_id, votes FROM mk JOIN ct USING (scene_id, instance_id) WHERE CASE WHEN cnt >= 32 AND halves >= 16 THEN half WHEN cnt >= 32 AND wides >= 8 THEN wide ELSE true END", "points", "images", "cameras", "mask_pixels")
def voted_object_points(spark, d):
    return L.voted_core(view(spark, d, "points"), _votes(spark, d)).select("scene_id", "instance_id", "point_id", "votes")


VIDS = "v0 AS (SELECT scene_id, (row_number() OVER (PARTITION BY scene_id ORDER BY point_id) - 1) * 10 + CAST(substr(scene_id, 2) AS INT) AS vid, round(x, 0) AS x, round(y, 0) AS y, round(z, 0) AS z FROM points)"


@R.query(f"WITH {VIDS} SELECT scene_id, vid, CASE WHEN scene_id < 's5' THEN -2*y+1 ELSE x END AS x, CASE WHEN scene_id < 's5' THEN 2*x+2 ELSE y END AS y, CASE WHEN scene_id < 's5' THEN 2*z+3 ELSE z END AS z FROM v0", "points")
def transform_mesh(spark, d):
    vertices = _mesh(spark, d)[0]
    moves = vertices.where("mesh_id < 's5'").select("mesh_id").distinct().select("mesh_id", F.array(*map(F.lit, M)).alias("matrix"))
    return rounded(H.transform_mesh(vertices, moves).select(F.col("mesh_id").alias("scene_id"), "vid", "x", "y", "z"))


@R.query(f"WITH {VIDS}, c AS (SELECT scene_id, CASE WHEN scene_id < 's5' THEN avg(x) ELSE 0 END AS ax, CASE WHEN scene_id < 's5' THEN avg(y) ELSE 0 END AS ay, CASE WHEN scene_id < 's5' THEN avg(z) ELSE 0 END AS az FROM v0 GROUP BY 1) SELECT scene_id, vid, round(x-ax, 6) AS x, round(y-ay, 6) AS y, round(z-az, 6) AS z FROM v0 JOIN c USING (scene_id)", "points")
def localize_mesh(spark, d):
    vertices = _mesh(spark, d)[0]
    mass = vertices.groupBy("mesh_id").agg(*[F.when(F.col("mesh_id") < "s5", F.avg(c)).alias(f"com_{c}") for c in "xyz"])
    return rounded(H.localize_mesh(vertices, mass)[0].select(F.col("mesh_id").alias("scene_id"), "vid", "x", "y", "z"))


@R.query("WITH r AS (SELECT k, size / 5e1 AS ex, (k % 10) / 1e1 AS ey FROM objects) SELECT k, greatest(ex, ey, 0.05) > 0.6 AS clamped, round(CASE WHEN greatest(ex, ey, 0.05) > 0.6 THEN ex / 2 END, 6) AS box_cx, round(CASE WHEN greatest(ex, ey, 0.05) > 0.6 THEN least(greatest(ex*0.45, 0.08), 0.45) END, 6) AS box_x, round(CASE WHEN greatest(ex, ey, 0.05) > 0.6 THEN 0.08e0 END, 6) AS box_z FROM r", "objects")
def clamp_extent(spark, d):
    sides = {"x": F.col("size") / 50.0, "y": F.col("k") % 10 / 10.0, "z": F.lit(0.05)}
    reports = view(spark, d, "objects").select("k", *[x.alias(f"{n}_{c}") for c, e in sides.items() for n, x in (("min", F.lit(0.0)), ("max", e), ("extent", e))])
    return rounded(H.clamp_extent(reports).select("k", "clamped", "box_cx", "box_x", "box_z"))
