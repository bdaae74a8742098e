"""Queries over poses, projections and scalar geometry, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaframe.functions import geometry as G
from vistaframe.functions import names as N
from vistaframe.operators import cameras as C
from vistaframe.plans.helpers import Registry, rounded
from vistaframe.sources.fixtures import view
from vistaframe.sources.tables import table

R = Registry()

ROT = "1-2*(qy*qy+qz*qz) AS r0, 2*(qx*qy-qw*qz) AS r1, 2*(qx*qz+qw*qy) AS r2, 2*(qx*qy+qw*qz) AS r3, 1-2*(qx*qx+qz*qz) AS r4, 2*(qy*qz-qw*qx) AS r5, 2*(qx*qz-qw*qy) AS r6, 2*(qy*qz+qw*qx) AS r7, 1-2*(qx*qx+qy*qy) AS r8"
PROJECTED = f"""
rot AS (SELECT *, {ROT} FROM images JOIN cameras USING (scene_id, camera_id)),
cam AS (
  SELECT p.scene_id, p.point_id, r.image_id, model, width, height, fx, CASE WHEN model LIKE '%RADIAL' OR model = 'SIMPLE_PINHOLE' THEN fx ELSE fy END AS fy, cx, cy,
    r0*x+r1*y+r2*z+tx AS a, r3*x+r4*y+r5*z+ty AS b, r6*x+r7*y+r8*z+tz AS c
  FROM points p JOIN rot r USING (scene_id)
),
proj AS (SELECT *, fx*a/(c+1e-12)+cx AS u, fy*b/(c+1e-12)+cy AS v FROM cam)"""


@R.query(f"WITH {PROJECTED}, seen AS (SELECT scene_id, point_id, count(*) AS views FROM proj WHERE c > 1e-6 AND u >= 0 AND u < width AND v >= 0 AND v < height GROUP BY ALL) SELECT scene_id, point_id, coalesce(views, 0) AS views FROM points LEFT JOIN seen USING (scene_id, point_id)", "points", "images", "cameras")
def view_counts(spark, d):
    return C.view_counts(view(spark, d, "points"), view(spark, d, "images"), view(spark, d, "cameras"))


@R.query(f"WITH {PROJECTED}, seen AS (SELECT scene_id, point_id, count(*) AS views FROM proj WHERE c > 1e-6 AND c < 5 AND u >= -50 AND u < width + 50 AND v >= -50 AND v < height + 50 GROUP BY ALL) SELECT scene_id, point_id, coalesce(views, 0) AS views FROM points LEFT JOIN seen USING (scene_id, point_id)", "points", "images", "cameras")
def view_counts_margin(spark, d):
    return C.view_counts(view(spark, d, "points"), view(spark, d, "images"), view(spark, d, "cameras"), margin=50.0, max_depth=5.0)


@R.query("SELECT scene_id, image_id, camera_id, model, round(qw, 6) AS qw FROM images JOIN cameras USING (scene_id, camera_id)", "images", "cameras")
def poses_with_cameras(spark, d):
    return rounded(C.poses_with_cameras(view(spark, d, "images"), view(spark, d, "cameras")).select("scene_id", "image_id", "camera_id", "model", "qw"))


@R.query(f"SELECT scene_id, image_id, {', '.join(f'round(r{k}, 6) AS r{k}' for k in range(9))} FROM (SELECT *, {ROT} FROM images)", "images")
def quat_to_rotmat(spark, d):
    r = G.quat_to_rotmat(C.quaternion())
    return rounded(view(spark, d, "images").select("scene_id", "image_id", *[c.alias(f"r{k}") for k, c in enumerate(r)]))


@R.query(f"WITH n AS (SELECT scene_id, image_id, qw/l AS qw, qx/l AS qx, qy/l AS qy, qz/l AS qz FROM (SELECT scene_id, image_id, qw+0.5 AS qw, qx+0.25 AS qx, qy, qz, sqrt((qw+0.5)**2+(qx+0.25)**2+qy*qy+qz*qz) AS l FROM images)) SELECT scene_id, image_id, {', '.join(f'round(r{k}, 6) AS r{k}' for k in range(9))} FROM (SELECT *, {ROT} FROM n)", "images")
def quat_to_rotmat_normalized(spark, d):
    q = [F.col("qw") + 0.5, F.col("qx") + 0.25, F.col("qy"), F.col("qz")]
    return rounded(view(spark, d, "images").select("scene_id", "image_id", *[c.alias(f"r{k}") for k, c in enumerate(G.quat_to_rotmat(q, normalize=True))]))


@R.query("WITH l AS (SELECT *, sqrt(qw*qw+qy*qy)+1e-12 AS l FROM images) SELECT scene_id, image_id, round(abs(qw/l), 5) AS w, round(abs(qx/l), 5) AS x, round(abs(qy/l), 5) AS y, round(abs(qz/l), 5) AS z FROM l", "images")
def rotmat_to_quat(spark, d):
    q = G.rotmat_to_quat(G.quat_to_rotmat(C.quaternion()))
    return rounded(view(spark, d, "images").select("scene_id", "image_id", *[F.abs(c).alias(n) for c, n in zip(q, "wxyz", strict=True)]), 5)


@R.query(f"SELECT scene_id, image_id, round(-(r0*tx+r3*ty+r6*tz), 6) AS x, round(-(r1*tx+r4*ty+r7*tz), 6) AS y, round(-(r2*tx+r5*ty+r8*tz), 6) AS z FROM (SELECT *, {ROT} FROM images)", "images")
def camera_center(spark, d):
    c = G.camera_center(C.quaternion(), C.translation())
    return rounded(view(spark, d, "images").select("scene_id", "image_id", *[v.alias(n) for v, n in zip(c, "xyz", strict=True)]))


@R.query(f"SELECT scene_id, image_id, round(-r3, 6) AS x, round(-r4, 6) AS y, round(-r5, 6) AS z FROM (SELECT *, {ROT} FROM images)", "images")
def camera_up(spark, d):
    return rounded(view(spark, d, "images").select("scene_id", "image_id", *[v.alias(n) for v, n in zip(G.camera_up(C.quaternion()), "xyz", strict=True)]))


@R.query(f"WITH m AS (SELECT scene_id, avg(-r3) AS x, avg(-r4) AS y, avg(-r5) AS z FROM (SELECT *, {ROT} FROM images) GROUP BY 1), l AS (SELECT *, sqrt(x*x+y*y+z*z) AS l FROM m) SELECT scene_id, round(CASE WHEN l > 1e-9 THEN x/l ELSE 0 END, 6) AS x, round(CASE WHEN l > 1e-9 THEN y/l ELSE 0 END, 6) AS y, round(CASE WHEN l > 1e-9 THEN z/l ELSE 1 END, 6) AS z FROM l", "images")
def scene_up(spark, d):
    return rounded(C.scene_up(view(spark, d, "images")))


@R.query(f"SELECT scene_id, image_id, round(r0, 6) AS w0, round(r1, 6) AS w1, round(r2, 6) AS w2, round(tx, 6) AS w9, round(ty, 6) AS w10, round(tz, 6) AS w11 FROM (SELECT *, {ROT} FROM images)", "images")
def c2w_to_w2c(spark, d):
    """The inverse of a pose's own camera-to-world matrix is the pose."""
    r = G.quat_to_rotmat(C.quaternion())
    c = G.camera_center(C.quaternion(), C.translation())
    m = F.array(r[0], r[3], r[6], c[0], r[1], r[4], r[7], c[1], r[2], r[5], r[8], c[2], F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    out = G.c2w_to_w2c(F.col("c2w"))
    rows = view(spark, d, "images").select("scene_id", "image_id", m.alias("c2w"))
    return rounded(rows.select("scene_id", "image_id", *[out[k].alias(f"w{k}") for k in (0, 1, 2, 9, 10, 11)]))


def seen_in_images(spark, d, poses, seen):
    """Rows for the points with all images of alike() poses that they lie in front of, by the columns (u, v, depth); these are rounded once for all equal poses."""
    u, v, z = seen
    rows = C.paired(view(spark, d, "points").select("scene_id", "point_id", "x", "y", "z"), poses).select("scene_id", "point_id", "images", u.alias("u"), v.alias("v"), z.alias("depth"))
    rows = rows.where("depth > 0.5").select("scene_id", "point_id", "images", F.round("u", 4).alias("u"), F.round("v", 4).alias("v"), F.round("depth", 6).alias("depth"))
    return rows.select("scene_id", "point_id", F.explode("images").alias("image_id"), "u", "v", "depth")


@R.query(f"WITH {PROJECTED} SELECT scene_id, point_id, image_id, round(u, 4) AS u, round(v, 4) AS v, round(c, 6) AS depth FROM proj WHERE model IN ('SIMPLE_PINHOLE', 'PINHOLE', 'OPENCV') AND c > 0.5", "points", "images", "cameras")
def project_w2c(spark, d):
    poses = C.poses_with_cameras(view(spark, d, "images"), view(spark, d, "cameras")).where(F.col("model").isin(*G.PROJECTED))
    poses = C.alike(poses.select("scene_id", "image_id", *C.POSE, "model", "fx", "fy", "cx", "cy"))
    return seen_in_images(spark, d, poses, G.project_w2c(C.xyz(), C.quaternion(), C.translation(), *[F.col(c) for c in ("model", "fx", "fy", "cx", "cy")]))


@R.query("SELECT scene_id, camera_id, fx AS f0, CASE WHEN model IN ('SIMPLE_PINHOLE', 'SIMPLE_RADIAL', 'RADIAL') THEN fx ELSE fy END AS f1 FROM cameras", "cameras")
def focal_terms(spark, d):
    x, y = G.focal_terms(F.col("model"), F.col("fx"), F.col("fy"))
    return view(spark, d, "cameras").select("scene_id", "camera_id", x.alias("f0"), y.alias("f1"))


@R.query("SELECT scene_id, camera_id, greatest(width // 3, 1) AS width, greatest(height // 3, 1) AS height, round(fx/3, 6) AS fx, round(cx/3, 6) AS cx FROM cameras", "cameras")
def rescale_intrinsics(spark, d):
    w, h, (fx, cx) = G.rescale_intrinsics(F.col("width"), F.col("height"), [F.col("fx"), F.col("cx")], 3)
    return rounded(view(spark, d, "cameras").select("scene_id", "camera_id", w.cast("long").alias("width"), h.cast("long").alias("height"), fx.alias("fx"), cx.alias("cx")))


META = "SELECT image_id, CASE WHEN image_id % 3 = 0 THEN 400e0 + image_id END AS fl, CASE WHEN image_id % 3 = 1 THEN 0.9e0 END AS angle FROM images"


@R.query(f"SELECT image_id, round(coalesce(fl, 640e0/2/tan(angle/2), 512e0), 6) AS f, round(coalesce(degrees(2*atan(tan(angle/2)*480/640)), degrees(2*atan(480e0/(fl+fl))), 60e0), 6) AS fov FROM ({META})", "images")
def intrinsics_from_meta(spark, d):
    rows = view(spark, d, "images").select("image_id", F.when(F.col("image_id") % 3 == 0, 400.0 + F.col("image_id")).alias("fl"), F.when(F.col("image_id") % 3 == 1, 0.9).alias("angle"))
    f, _ = G.intrinsics_from_meta(F.col("fl"), F.col("fl"), F.col("angle"), F.lit(640.0))
    return rounded(rows.select("image_id", f.alias("f"), G.fov_deg(F.col("fl"), F.col("fl"), F.col("angle"), F.lit(640.0), F.lit(480.0)).alias("fov")))


M = [0.0, -2.0, 0.0, 1.0, 2.0, 0.0, 0.0, 2.0, 0.0, 0.0, 2.0, 3.0, 0.0, 0.0, 0.0, 1.0]


@R.query("SELECT scene_id, point_id, round(-2*y+1, 6) AS x, round(2*x+2, 6) AS y, round(2*z+3, 6) AS z FROM points", "points")
def apply_transform(spark, d):
    m = F.array(*map(F.lit, M))
    return rounded(view(spark, d, "points").select("scene_id", "point_id", *[c.alias(n) for c, n in zip(G.apply_transform(C.xyz(), m), "xyz", strict=True)]))


@R.query("WITH b AS (SELECT scene_id, min(x) AS a, min(y) AS b, min(z) AS c, max(x) AS d, max(y) AS e, max(z) AS f FROM points GROUP BY 1) SELECT scene_id, round(-2*e+1, 6) AS lo_x, round(2*a+2, 6) AS lo_y, round(2*c+3, 6) AS lo_z, round(-2*b+1, 6) AS hi_x, round(2*d+2, 6) AS hi_y, round(2*f+3, 6) AS hi_z FROM b", "points")
def transform_aabb(spark, d):
    from vistaframe.operators.cloud import extent

    boxes = extent(view(spark, d, "points"))
    low, high = G.transform_aabb([F.col(f"min_{c}") for c in "xyz"], [F.col(f"max_{c}") for c in "xyz"], F.array(*map(F.lit, M)))
    return rounded(boxes.select("scene_id", *[c.alias(f"{n}_{a}") for n, box in (("lo", low), ("hi", high)) for c, a in zip(box, "xyz", strict=True)]))


@R.query("SELECT image_id, round(CASE WHEN image_id % 2 = 0 THEN 2e0 ELSE power(2e0*2e0*image_id, 1e0/3) END, 6) AS scale, image_id % 2 = 0 OR image_id = 2 AS similar FROM images", "images")
def validate_similarity(spark, d):
    last = F.when(F.col("image_id") % 2 == 0, 2.0).otherwise(F.col("image_id") * 1.0)
    m = F.array(*[last if k == 10 else F.lit(v) for k, v in enumerate(M)])
    rows = view(spark, d, "images").select("image_id", m.alias("m"))
    return rounded(rows.select("image_id", G.uniform_scale(F.col("m")).alias("scale"), G.is_similarity(F.col("m")).alias("similar")))


LABEL_BOX = "(xc-w/2)*640 AS x0, (yc-h/2)*480 AS y0, (xc+w/2)*640 AS x1, (yc+h/2)*480 AS y1"


@R.query(f"SELECT scene_id, image_id, ordinal, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1 FROM (SELECT *, {LABEL_BOX} FROM labels2d)", "labels2d")
def label_to_xyxy(spark, d):
    box = G.label_to_xyxy(*[F.col(c) for c in ("xc", "yc", "w", "h")], F.lit(640), F.lit(480))
    return rounded(view(spark, d, "labels2d").select("scene_id", "image_id", "ordinal", *[c.alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"), strict=True)]))


@R.query("SELECT ordinal, round((x0+x1)/2/640, 9) AS xc, round((y0+y1)/2/480, 9) AS yc, round((x1-x0)/640, 9) AS w, round((y1-y0)/480, 9) AS h FROM detections", "detections")
def xyxy_to_label(spark, d):
    label = G.xyxy_to_label([F.col(c) for c in ("x0", "y0", "x1", "y1")], F.lit(640), F.lit(480))
    return rounded(view(spark, d, "detections").select("ordinal", *[c.alias(n) for c, n in zip(label, ("xc", "yc", "w", "h"), strict=True)]), 9)


PAIRS = "SELECT a.scene_id, a.image_id, a.ordinal AS one, b.ordinal AS two, a.class_id AS ca, b.class_id AS cb, greatest(least(a.x1,b.x1)-greatest(a.x0,b.x0),0)*greatest(least(a.y1,b.y1)-greatest(a.y0,b.y0),0) AS i, (a.x1-a.x0)*(a.y1-a.y0)+(b.x1-b.x0)*(b.y1-b.y0) AS s FROM x a JOIN x b ON a.scene_id=b.scene_id AND a.image_id=b.image_id AND a.ordinal<b.ordinal"


def _pairs(spark, d):
    box = G.label_to_xyxy(*[F.col(c) for c in ("xc", "yc", "w", "h")], F.lit(640), F.lit(480))
    rows = view(spark, d, "labels2d").select("scene_id", "image_id", "ordinal", "class_id", *[c.alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"), strict=True)])
    other = rows.select("scene_id", "image_id", *[F.col(c).alias(f"_{c}") for c in ("ordinal", "class_id", "x0", "y0", "x1", "y1")])
    return rows.join(other, ["scene_id", "image_id"]).where("ordinal < _ordinal"), [F.col(c) for c in ("x0", "y0", "x1", "y1")], [F.col(f"_{c}") for c in ("x0", "y0", "x1", "y1")]


@R.query(f"WITH x AS (SELECT *, {LABEL_BOX} FROM labels2d), p AS ({PAIRS}) SELECT scene_id, image_id, one, two, round(i/greatest(s-i,1e-9), 6) AS iou FROM p", "labels2d")
def box_iou(spark, d):
    rows, a, b = _pairs(spark, d)
    return rounded(rows.select("scene_id", "image_id", F.col("ordinal").alias("one"), F.col("_ordinal").alias("two"), G.box_iou(a, b).alias("iou")))


@R.query(f"WITH x AS (SELECT *, {LABEL_BOX} FROM labels2d), p AS ({PAIRS}) SELECT scene_id, image_id, one, two, round(CASE WHEN ca=cb THEN i/(s-i+1e-6) ELSE 0 END, 6) AS iou FROM p", "labels2d")
def label_iou(spark, d):
    rows, a, b = _pairs(spark, d)
    return rounded(rows.select("scene_id", "image_id", F.col("ordinal").alias("one"), F.col("_ordinal").alias("two"), G.label_iou(a, F.col("class_id"), b, F.col("_class_id")).alias("iou")))


@R.query("WITH p AS (SELECT a.image_id, a.qw AS w0, a.qy AS y0, b.qw AS w1, b.qy AS y1 FROM images a JOIN images b ON b.image_id=a.image_id+1), s AS (SELECT *, CASE WHEN w0*w1+y0*y1<0 THEN -1e0 ELSE 1e0 END AS g FROM p), o AS (SELECT *, acos(least(abs(w0*w1+y0*y1),1e0)) AS o, abs(w0*w1+y0*y1)>0.9995 AS near FROM s), m AS (SELECT image_id, CASE WHEN near THEN 0.7*w0+0.3*g*w1 ELSE sin(0.7*o)/sin(o)*w0+sin(0.3*o)/sin(o)*g*w1 END AS w, CASE WHEN near THEN 0.7*y0+0.3*g*y1 ELSE sin(0.7*o)/sin(o)*y0+sin(0.3*o)/sin(o)*g*y1 END AS y FROM o) SELECT image_id, round(w/sqrt(w*w+y*y), 6) AS w, round(y/sqrt(w*w+y*y), 6) AS y FROM m", "images")
def slerp(spark, d):
    rows = view(spark, d, "images").select("image_id", "qw", "qx", "qy", "qz")
    after = rows.select((F.col("image_id") - 1).alias("image_id"), *[F.col(c).alias(f"_{c}") for c in C.POSE[:4]])
    q = G.slerp(C.quaternion(), [F.col(f"_{c}") for c in C.POSE[:4]], F.lit(0.3))
    return rounded(rows.join(after, "image_id").select("image_id", q[0].alias("w"), q[2].alias("y")))


@R.query("SELECT frame_id, replace(regexp_replace(path, '\\.[^./]*$', ''), '/', '_') AS label_key, TRY_CAST(regexp_extract(regexp_extract(path, '[^/]*$'), '^frame_([0-9]+)\\.', 1) AS BIGINT) AS idx, CAST(regexp_extract(path, '[0-9]+') AS BIGINT) AS sort_key, regexp_extract(path, '^(.*)/', 1) AS session FROM frames", "frames")
def frame_keys(spark, d):
    path = F.col("path")
    return view(spark, d, "frames").select("frame_id", N.frame_label_key(path).alias("label_key"), N.frame_index(N.stem(path)).alias("idx"), N.frame_sort_key(path).alias("sort_key"), N.session_of(path).alias("session"))


@R.query("SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'object') AS slug FROM part")
def class_slug(spark, d):
    return table(spark, d, "part").select("p_partkey", N.class_slug(F.col("p_brand")).alias("slug"))


@R.query("SELECT frame_id, round(CAST(concat('0x', substr(sha256('3:' || path), 1, 8)) AS BIGINT) / 4294967295e0, 9) AS bucket FROM frames", "frames")
def hash_bucket(spark, d):
    return view(spark, d, "frames").select("frame_id", F.round(N.hash_bucket(F.col("path"), 3), 9).alias("bucket"))


@R.query("WITH t(m, density, friction, roughness) AS (VALUES ('wood', 650e0, 0.55e0, 0.65e0), ('metal', 7800e0, 0.35e0, 0.3e0)), n AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'wood' WHEN 1 THEN 'metal' ELSE 'other' END AS m FROM part) SELECT p_partkey, coalesce(density, 700e0) AS density, coalesce(friction, 0.5e0) AS friction, coalesce(roughness, 0.6e0) AS roughness FROM n LEFT JOIN t USING (m)")
def templates(spark, d):
    name = F.when(F.col("p_size") % 3 == 0, "wood").when(F.col("p_size") % 3 == 1, "metal").otherwise("other")
    physics = N.template(name, N.PHYSICS, ("density", "friction", "restitution"))
    material = N.template(name, N.MATERIALS, ("roughness", "metallic"))
    rows = table(spark, d, "part").select("p_partkey", physics.alias("p"), material.alias("m"))
    return rows.select("p_partkey", "p.density", "p.friction", "m.roughness")
