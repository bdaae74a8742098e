"""Queries over masks, tracks and meshes, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaframe.operators import masks as K
from vistaframe.operators import meshes as H
from vistaframe.operators import tracks as T
from vistaframe.operators.cameras import poses_with_cameras, turned
from vistaframe.plans.helpers import Registry, rounded, solved
from vistaframe.sources.fixtures import view
from vistaframe.sources.tables import written

R = Registry()


@R.query("SELECT scene_id, instance_id, count(DISTINCT frame) AS frames, round(count(*) / (count(DISTINCT frame) * 350e0), 6) AS foreground, count(DISTINCT frame) >= 18 AS meets_min_views FROM mask_pixels GROUP BY ALL", "mask_pixels")
def mask_report(spark, d):
    return rounded(K.mask_report(view(spark, d, "mask_pixels"), 350, 18))


@R.query("SELECT scene_id, instance_id, frame, count(*) AS area FROM mask_pixels GROUP BY ALL HAVING count(*) >= 50", "mask_pixels")
def min_area_masks(spark, d):
    return K.min_area_masks(view(spark, d, "mask_pixels"), 50)


@R.query("SELECT scene_id, frame, round(count(*) / 350e0, 6) AS fraction FROM (SELECT DISTINCT scene_id, frame, u, v FROM mask_pixels) GROUP BY ALL", "mask_pixels")
def masked_pixel_fraction(spark, d):
    return rounded(K.masked_pixel_fraction(view(spark, d, "mask_pixels"), 350))


@R.query("SELECT scene_id, frame, u, v, CASE WHEN max(CASE WHEN instance_id = 'i1' THEN 1 ELSE 0 END) = 1 THEN 'i1' ELSE min(instance_id) END AS origin, array_to_string(list_sort(list(DISTINCT instance_id)), ',') AS owners FROM mask_pixels WHERE instance_id IN ('i1', 'i2', 'i4') GROUP BY ALL", "mask_pixels")
def merge_instances(spark, d):
    return K.merge_instances(view(spark, d, "mask_pixels"), "i1", ["i2", "i4"]).select("scene_id", "frame", "u", "v", "origin", F.array_join("owners", ",").alias("owners"))


@R.query("SELECT scene_id, frame, u, v FROM (SELECT DISTINCT scene_id, frame, u, v FROM mask_pixels WHERE instance_id IN ('i1', 'i4'))", "mask_pixels")
def unmerge_instances(spark, d):
    merged = K.merge_instances(view(spark, d, "mask_pixels"), "i1", ["i2", "i4"])
    return K.unmerge_instances(merged, ["i2"]).select("scene_id", "frame", "u", "v")


@R.query("WITH s AS (SELECT scene_id, frame, u, v, bool_or(instance_id = 'i1') AS own, bool_or(instance_id <> 'i1') AS other FROM mask_pixels WHERE instance_id IN ('i1', 'i2') GROUP BY ALL) SELECT scene_id, frame, count(*) FILTER (own) AS \"primary\", count(*) FILTER (NOT own) AS added, count(*) FILTER (own AND other) AS identical FROM s GROUP BY ALL", "mask_pixels")
def merge_counts(spark, d):
    return K.merge_counts(view(spark, d, "mask_pixels"), "i1", ["i2"])


@R.query("SELECT scene_id, instance_id, frame, count(*) AS pixels FROM mask_pixels WHERE NOT (instance_id = 'i3' AND frame < 5) GROUP BY ALL", "mask_pixels")
def delete_masks(spark, d):
    pixels = view(spark, d, "mask_pixels")
    names = pixels.where("instance_id = 'i3' AND frame < 5").select("scene_id", "instance_id", "frame").distinct()
    return K.delete_masks(pixels, names)[0].groupBy("scene_id", "instance_id", "frame").agg(F.count(F.lit(1)).alias("pixels"))


@R.query("SELECT scene_id, CASE WHEN instance_id = 'i0' AND scene_id <> 's1' THEN 'chair_001' ELSE instance_id END AS instance_id, count(*) AS pixels FROM mask_pixels GROUP BY ALL", "mask_pixels")
def rename_instances(spark, d):
    pixels = view(spark, d, "mask_pixels")
    names = pixels.where("scene_id <> 's1'").select("scene_id").distinct().select("scene_id", F.lit("i0").alias("old"), F.lit("chair_001").alias("new"))
    return K.rename_instances(pixels, names).groupBy("scene_id", "instance_id").agg(F.count(F.lit(1)).alias("pixels"))


@R.query("WITH g AS (SELECT scene_id, frame, u + 1 AS u, v + 1 AS v FROM (SELECT DISTINCT scene_id, frame FROM mask_pixels) CROSS JOIN range(50) a(u) CROSS JOIN range(7) b(v)), m AS (SELECT DISTINCT scene_id, frame, u, v FROM mask_pixels WHERE instance_id <> 'i5') SELECT g.scene_id, g.frame, count(*) AS kept FROM g ANTI JOIN m ON g.scene_id = m.scene_id AND g.frame = m.frame AND g.u = m.u AND g.v = m.v GROUP BY ALL", "mask_pixels")
def keep_masks(spark, d):
    pixels = view(spark, d, "mask_pixels")
    frames = pixels.select("scene_id", "frame").distinct().withColumns({"width": F.lit(50), "height": F.lit(7)})
    return K.keep_masks(pixels.where("instance_id <> 'i5'"), K.frame_grid(frames)).groupBy("scene_id", "frame").agg(F.count(F.lit(1)).alias("kept"))


@R.query("WITH i AS (SELECT scene_id, frame, u, v, min(instance_id) AS value FROM mask_pixels GROUP BY ALL), m AS (SELECT DISTINCT scene_id, frame, u, v FROM mask_pixels WHERE instance_id = 'i2') SELECT i.scene_id, i.frame, i.u, i.v, CASE WHEN m.u IS NOT NULL AND i.u % 2 = 0 THEN 'plate' ELSE value END AS value FROM i LEFT JOIN m ON i.scene_id = m.scene_id AND i.frame = m.frame AND i.u = m.u AND i.v = m.v", "mask_pixels")
def composite_clean_plate(spark, d):
    pixels = view(spark, d, "mask_pixels")
    image = pixels.groupBy("scene_id", "frame", "u", "v").agg(F.min("instance_id").alias("value"))
    plate = image.where("u % 2 = 0").withColumn("value", F.lit("plate"))
    return K.composite_clean_plate(image, pixels.where("instance_id = 'i2'"), plate)


@R.query("WITH a AS (SELECT scene_id, instance_id, frame, count(*) AS area FROM mask_pixels GROUP BY ALL) SELECT scene_id, instance_id, arg_max(frame, (area, -frame)) AS frame, max(area) AS area FROM a GROUP BY ALL", "mask_pixels")
def best_view(spark, d):
    return K.best_view(K.min_area_masks(view(spark, d, "mask_pixels"), 1))


@R.query("WITH g AS (SELECT *, u - row_number() OVER (PARTITION BY scene_id, instance_id, frame, v ORDER BY u) AS k FROM mask_pixels) SELECT scene_id, instance_id, frame, v, min(u) AS start, count(*) AS length FROM g GROUP BY scene_id, instance_id, frame, v, k", "mask_pixels")
def mask_runs(spark, d):
    return K.runs(view(spark, d, "mask_pixels"))


ROT = "1-2*(qy*qy+qz*qz) AS r0, 2*(qx*qy-qw*qz) AS r1, 2*(qx*qz+qw*qy) AS r2, 2*(qx*qy+qw*qz) AS r3, 1-2*(qx*qx+qz*qz) AS r4, 2*(qy*qz-qw*qx) AS r5, 2*(qx*qz-qw*qy) AS r6, 2*(qy*qz+qw*qx) AS r7, 1-2*(qx*qx+qy*qy) AS r8"
VOTES = f"""rot AS (SELECT *, {ROT} FROM images JOIN cameras USING (scene_id, camera_id)),
cam AS (SELECT p.scene_id, p.point_id, r.image_id % 20 AS frame, CASE WHEN model LIKE '%RADIAL' OR model = 'SIMPLE_PINHOLE' THEN fx ELSE fy END AS fy, fx, cx, cy, r0*x+r1*y+r2*z+tx AS a, r3*x+r4*y+r5*z+ty AS b, r6*x+r7*y+r8*z+tz AS c FROM points p JOIN rot r USING (scene_id)),
px AS (SELECT scene_id, point_id, frame, CAST(round_even((fx*a/(c+1e-12)+cx) / 12, 0) AS BIGINT) AS u, CAST(round_even((fy*b/(c+1e-12)+cy) / 60, 0) AS BIGINT) AS v FROM cam WHERE c > 0.05 AND abs(fx*a/(c+1e-12)+cx) < 1e6 AND abs(fy*b/(c+1e-12)+cy) < 1e6),
votes AS (SELECT px.scene_id, instance_id, point_id, count(*) AS votes FROM px JOIN mask_pixels m ON px.scene_id = m.scene_id AND px.frame = m.frame AND px.u = m.u AND px.v = m.v WHERE px.u BETWEEN 0 AND 52 AND px.v BETWEEN 0 AND 7 GROUP BY ALL)"""


def _votes(spark, d):
    """Points against masks on a grid of 53 by 8 pixels. A table."""
    poses = turned(poses_with_cameras(view(spark, d, "images"), view(spark, d, "cameras")))
    rows = poses.withColumns({"frame": F.col("image_id") % 20, "su": F.lit(12.0), "sv": F.lit(60.0), "width": F.lit(53), "height": F.lit(8)})
    return written(K.cloud_votes(view(spark, d, "points"), rows, view(spark, d, "mask_pixels")))


@R.query(f"WITH {VOTES} SELECT * FROM votes", "points", "images", "cameras", "mask_pixels")
def mask_votes(spark, d):
    return _votes(spark, d)


@R.query(f"WITH {VOTES}, n AS (SELECT scene_id, instance_id, count(*) FILTER (votes >= 2) AS many, count(*) AS every FROM votes GROUP BY ALL) SELECT scene_id, instance_id, point_id, votes FROM votes JOIN n USING (scene_id, instance_id) WHERE votes >= CASE WHEN many >= 16 THEN 2 WHEN every >= 8 THEN 1 END", "points", "images", "cameras", "mask_pixels")
def select_voted_points(spark, d):
    return K.select_voted_points(_votes(spark, d))


@R.query("SELECT ordinal, dense_rank() OVER (PARTITION BY scene_id ORDER BY frame) AS rank FROM detections", "detections")
def frame_rank(spark, d):
    return T.frame_rank(view(spark, d, "detections")).select("ordinal", "rank")


IOU = "greatest(least(t.x1, d.x1) - greatest(t.x0, d.x0), 0) * greatest(least(t.y1, d.y1) - greatest(t.y0, d.y0), 0)"
AREAS = "greatest(t.x1 - t.x0, 0) * greatest(t.y1 - t.y0, 0) + greatest(d.x1 - d.x0, 0) * greatest(d.y1 - d.y0, 0)"
ASSOCIATED = f"""WITH RECURSIVE rk AS (SELECT *, dense_rank() OVER (PARTITION BY scene_id ORDER BY frame) AS rank FROM detections),
de AS (SELECT *, row_number() OVER (PARTITION BY scene_id, class_name ORDER BY rank, confidence DESC, ordinal) AS k FROM rk),
st(scene_id, class_name, k, tracks, number, ordinal, given) AS (
  SELECT DISTINCT scene_id, class_name, 0::BIGINT, []::STRUCT(n BIGINT, last BIGINT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE)[], 0::BIGINT, 0::BIGINT, 0::BIGINT FROM detections
  UNION ALL
  SELECT scene_id, class_name, k, list_append(list_filter(tracks, lambda t: t.n <> got AND rank - t.last <= 2), {{'n': got, 'last': rank, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}), greatest(number, got), ordinal, got
  FROM (
    SELECT s.scene_id, s.class_name, d.k, s.tracks, s.number, d.ordinal, d.rank, d.x0, d.y0, d.x1, d.y1,
      coalesce(list_max(list_transform(list_filter(s.tracks, lambda t: t.last < d.rank AND d.rank - t.last <= 2 AND {IOU} / greatest({AREAS} - {IOU}, 1e-9) >= 0.25), lambda t: {{'o': {IOU} / greatest({AREAS} - {IOU}, 1e-9), 'n': t.n}})).n, s.number + 1) AS got
    FROM st s JOIN de d ON d.scene_id = s.scene_id AND d.class_name = s.class_name AND d.k = s.k + 1
  )
) SELECT scene_id, class_name, ordinal, given AS track FROM st WHERE k > 0"""


@R.query(ASSOCIATED, "detections")
def associate_detections(spark, d):
    return T.associate_detections(view(spark, d, "detections"))


@R.query("WITH t AS (SELECT scene_id, class_name, ordinal % 7 AS track, count(*) AS n, avg(confidence) AS c FROM detections GROUP BY ALL HAVING count(*) >= 20), r AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY c * log2(n + 1) DESC, n DESC, class_name, track) AS rank FROM t) SELECT scene_id, class_name, track, n AS detections, round(c, 6) AS confidence, rank FROM r WHERE rank <= 5", "detections")
def rank_tracks(spark, d):
    members = view(spark, d, "detections").withColumn("track", F.col("ordinal") % 7)
    return rounded(T.rank_tracks(T.track_summary(members), 20, 5))


@R.query("SELECT scene_id, class_name, ordinal % 7 AS track, arg_max(ordinal, (confidence, -ordinal)) AS ordinal FROM detections WHERE ordinal % 3 <> 0 AND (scene_id, frame) IN (SELECT (scene_id, frame) FROM detections WHERE ordinal % 10 < 4) GROUP BY ALL", "detections")
def best_prompt(spark, d):
    det = view(spark, d, "detections").withColumn("track", F.col("ordinal") % 7)
    return T.best_prompt(det.where("ordinal % 3 <> 0"), det.where("ordinal % 10 < 4").select("scene_id", "frame").distinct())


VERTICES = "v0 AS (SELECT scene_id, (row_number() OVER (PARTITION BY scene_id ORDER BY point_id) - 1) * 10 + CAST(substr(scene_id, 2) AS INT) AS vid, round(x, 0) AS x, round(y, 0) AS y, round(z, 0) AS z FROM points)"
CLEAN = f"""{VERTICES}, m AS (SELECT *, min(vid) OVER (PARTITION BY scene_id, x, y, z) AS t FROM v0),
f1 AS (SELECT faces.scene_id, fid, ma.t AS a, mb.t AS b, mc.t AS c FROM faces JOIN m ma ON a = ma.vid JOIN m mb ON b = mb.vid JOIN m mc ON c = mc.vid),
f2 AS (SELECT any_value(scene_id) AS scene_id, min(fid) AS fid, arg_min(a, fid) AS a, arg_min(b, fid) AS b, arg_min(c, fid) AS c FROM f1 WHERE a <> b AND b <> c AND a <> c GROUP BY list_sort([a, b, c])),
used AS (SELECT DISTINCT unnest([a, b, c]) AS vid FROM f2),
v2 AS (SELECT * FROM v0 WHERE vid IN (SELECT vid FROM used))"""


def _mesh(spark, d):
    """The points of each scene, on whole coordinates so that some coincide, as vertices of its mesh."""
    from pyspark.sql import Window

    points = view(spark, d, "points")
    vid = (F.row_number().over(Window.partitionBy("scene_id").orderBy("point_id")) - 1) * 10 + F.substring("scene_id", 2, 9).cast("int")
    vertices = points.select(F.col("scene_id").alias("mesh_id"), vid.cast("long").alias("vid"), *[(F.round(c, 0) + 0.0).alias(c) for c in "xyz"])
    return vertices, view(spark, d, "faces").withColumnRenamed("scene_id", "mesh_id")


@R.query(f"WITH {CLEAN} SELECT fid, a, b, c FROM f2", "points", "faces")
def mesh_clean(spark, d):
    return H.mesh_clean(*_mesh(spark, d))[1].select("fid", "a", "b", "c")


LOCATED = "p AS (SELECT f2.*, va.x AS ax, va.y AS ay, va.z AS az, vb.x AS bx, vb.y AS by_, vb.z AS bz, vc.x AS cx, vc.y AS cy, vc.z AS cz FROM f2 JOIN v2 va ON a = va.vid JOIN v2 vb ON b = vb.vid JOIN v2 vc ON c = vc.vid)"
REPORTED = f"""{CLEAN}, {LOCATED}, s AS (SELECT scene_id, count(*) AS faces, abs(sum(ax*(by_*cz-bz*cy)+ay*(bz*cx-bx*cz)+az*(bx*cy-by_*cx)))/6 AS volume FROM p GROUP BY 1),
ed AS (SELECT scene_id, e, count(*) AS n FROM (SELECT scene_id, unnest([[least(a,b), greatest(a,b)], [least(b,c), greatest(b,c)], [least(a,c), greatest(a,c)]]) AS e FROM f2) GROUP BY ALL),
ee AS (SELECT scene_id, count(*) AS edges, bool_and(n = 2) AS watertight FROM ed GROUP BY 1),
vv AS (SELECT scene_id, count(*) AS vertices, {", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in "xyz")} FROM v2 GROUP BY 1)"""


@R.query(f"WITH {REPORTED} SELECT scene_id, vertices, faces, edges, round(volume, 3) AS volume, watertight, min_x, max_x, min_y, max_y, min_z, max_z FROM vv JOIN s USING (scene_id) JOIN ee USING (scene_id)", "points", "faces")
def mesh_report(spark, d):
    found = H.mesh_report(*H.mesh_clean(*_mesh(spark, d)))
    return found.select(F.col("mesh_id").alias("scene_id"), "vertices", "faces", "edges", F.round("volume", 3).alias("volume"), "watertight", *[f"{n}_{c}" for c in "xyz" for n in ("min", "max")])


@R.query("WITH r AS (SELECT fid, row_number() OVER (PARTITION BY scene_id ORDER BY fid) - 1 AS pos, ceil(count(*) OVER (PARTITION BY scene_id) / 400e0) AS step FROM faces) SELECT fid FROM r WHERE pos % step = 0", "faces")
def nth_face_decimate(spark, d):
    return H.nth_face_decimate(view(spark, d, "faces").withColumnRenamed("scene_id", "mesh_id"), 400).select("fid")


@R.query("WITH p AS (SELECT scene_id, point_id, x, y FROM points), b AS (SELECT scene_id, min(x) AS a, max(x) AS c, min(y) AS e, max(y) AS f FROM p GROUP BY 1) SELECT scene_id, point_id, round((x-a)/greatest(c-a,1e-6), 6) AS tu, round((y-e)/greatest(f-e,1e-6), 6) AS tv FROM p JOIN b USING (scene_id)", "points")
def planar_uv(spark, d):
    vertices = view(spark, d, "points").select(F.col("scene_id").alias("mesh_id"), F.col("point_id").alias("vid"), "x", "y")
    return rounded(H.planar_uv(vertices).select(F.col("mesh_id").alias("scene_id"), F.col("vid").alias("point_id"), "tu", "tv"))


REACHED = "n AS (SELECT DISTINCT a AS id FROM e WHERE a <> b), r(id, reach) AS (SELECT id, id FROM n UNION SELECT r.id, e.b FROM r JOIN e ON r.reach = e.a), linked AS (SELECT id, min(reach) AS component FROM r GROUP BY 1)"


@R.query(f"WITH RECURSIVE e AS (SELECT a, b FROM faces UNION SELECT b, a FROM faces UNION SELECT b, c FROM faces UNION SELECT c, b FROM faces), {REACHED} SELECT id, component FROM linked", "faces")
def components(spark, d):
    """Vertices that the edges of faces link."""
    from vistaframe.operators.graph import components as linked

    faces = view(spark, d, "faces")
    return linked(faces.select("a", "b").union(faces.select("b", "c")))


@R.query(f"WITH RECURSIVE {CLEAN}, {LOCATED}, e AS (SELECT a, b FROM f2 UNION SELECT b, a FROM f2 UNION SELECT b, c FROM f2 UNION SELECT c, b FROM f2), {REACHED}, nn AS (SELECT p.scene_id, component, az, bz, cz, (by_-ay)*(cz-az)-(bz-az)*(cy-ay) AS nx, (bz-az)*(cx-ax)-(bx-ax)*(cz-az) AS ny, (bx-ax)*(cy-ay)-(by_-ay)*(cx-ax) AS nz FROM p JOIN linked ON p.a = linked.id), l AS (SELECT *, sqrt(nx*nx+ny*ny+nz*nz) AS len FROM nn), g AS (SELECT scene_id, component, min(least(az,bz,cz)) AS low, abs(avg(CASE WHEN len > 0 THEN nz/len ELSE 0 END)) AS level, sum(len/2) AS area FROM l GROUP BY ALL), t AS (SELECT *, min(low) OVER (PARTITION BY scene_id) AS floor_, sum(area) OVER (PARTITION BY scene_id) AS total FROM g) SELECT scene_id, component, CASE WHEN low <= floor_ + 0.15 AND level >= 0.75 THEN 'floor' WHEN area >= greatest(1, total*0.05) THEN 'architecture' ELSE 'obstacle' END AS kind, round(area, 3) AS area FROM t", "points", "faces")
def classify_components(spark, d):
    from vistaframe.operators.graph import classify_components as classified
    from vistaframe.operators.graph import face_components

    vertices, faces = H.mesh_clean(*_mesh(spark, d))
    located = H.face_normals(H.with_corners(vertices, face_components(faces)))
    return classified(located).select(F.col("mesh_id").alias("scene_id"), "component", "kind", F.round("area", 3).alias("area"))


BODIES = f"""t AS (SELECT point_id // 21 * 5 + point_id % 21 // 4 AS mesh_id, {", ".join(f"max(CASE WHEN point_id % 21 % 4 = {k} THEN {c} END) AS {c}{k}" for k in range(4) for c in "xyz")} FROM points WHERE point_id % 21 < 20 GROUP BY 1),
v AS (SELECT *, abs((x1-x0)*((y2-y0)*(z3-z0)-(z2-z0)*(y3-y0)) + (y1-y0)*((z2-z0)*(x3-x0)-(x2-x0)*(z3-z0)) + (z1-z0)*((x2-x0)*(y3-y0)-(y2-y0)*(x3-x0)))/6 AS vol, {", ".join(f"({c}0+{c}1+{c}2+{c}3)/4 AS m{c}" for c in "xyz")} FROM t),
w AS (SELECT mesh_id, vol, mx, my, mz, {", ".join(f"10*vol/20*({'+'.join(f'({i}{k}-m{i})*({j}{k}-m{j})' for k in range(4))}) AS {n}" for n, i, j in zip("abcdef", "xyzxxy", "xyzyzz", strict=True))} FROM v),
ev AS ({solved("w", "mesh_id, vol, mx, my, mz, a+b+c AS tr")})"""


@R.query(f"WITH {BODIES}, o AS (SELECT *, mesh_id % 10 <> 0 AND vol > 1e-12 AS whole FROM ev) SELECT mesh_id, round(CASE WHEN whole THEN greatest(10*vol, 1e-4) END, 6) AS mass, {', '.join(f'round(CASE WHEN whole THEN m{c} END, 6) + 0e0 AS com_{c}' for c in 'xyz')}, {', '.join(f'round(CASE WHEN whole THEN greatest(tr-e{2 - k}, 1e-8) END, 6) AS i{k}' for k in range(3))}, CASE WHEN whole THEN 0.9e0 ELSE 0e0 END AS confidence FROM o", "points")
def mass_properties(spark, d):
    """Bodies of four points each; every tenth lacks a face."""
    points = view(spark, d, "points").where("point_id % 21 < 20").withColumn("mesh_id", F.floor(F.col("point_id") / 21) * 5 + F.floor(F.col("point_id") % 21 / 4))
    vertices = points.select("mesh_id", F.col("point_id").alias("vid"), *"xyz")
    corners = F.array(*[F.struct(*[(F.col("vid") + F.lit(k)).alias(c) for k, c in zip(face, "abc", strict=True)]) for face in ((0, 1, 2), (0, 3, 1), (1, 3, 2), (0, 2, 3))])
    sides = vertices.where("vid % 21 % 4 = 0").select("mesh_id", F.posexplode(corners).alias("side", "f")).where("side < 3 OR mesh_id % 10 <> 0")
    faces = sides.select("mesh_id", (F.col("mesh_id") * 4 + F.col("side")).alias("fid"), "f.*")
    found = H.mass_properties(vertices, faces, 10.0)
    return rounded(found.select("mesh_id", "mass", "com_x", "com_y", "com_z", *[F.get("inertia", F.lit(k)).alias(f"i{k}") for k in range(3)], "confidence"))
