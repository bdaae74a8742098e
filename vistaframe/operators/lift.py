"""From labels to objects in one call: boxes, merged objects, tables for debugging, coloured object clouds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaframe.functions import geometry as G
from vistaframe.operators import boxes as B
from vistaframe.operators import cameras as C
from vistaframe.operators import masks as K
from vistaframe.operators.held import HELD, MOVE, merged_digests
from vistaframe.operators.review import dense_core
from vistaframe.sources.tables import written

#: A colour of points that nothing has seen.
UNSEEN = 180


def alias_classes(detections: DataFrame, aliases: DataFrame) -> DataFrame:
    """detections with class_id by aliases (alias, class_id, ordinal), compared without case; of several the first. Others are dropped."""
    first = aliases.groupBy(F.lower(F.trim("alias")).alias("_name")).agg(F.min_by("class_id", "ordinal").alias("class_id"))
    return detections.withColumn("_name", F.lower(F.trim("class_name"))).join(first, "_name").drop("_name")


def camera_for_held_out(held_out: DataFrame, poses: DataFrame, key: list[str]) -> DataFrame:
    """held_out with the pose of each view; nulls where it has none."""
    return held_out.join(poses.drop(*[c for c in held_out.columns if c not in key]), key, "left")


def debug_frames(images: DataFrame, labels: DataFrame, stride: int, most: int) -> DataFrame:
    """Of every stride-th image of a scene in order of name the first `most` that have labels."""
    by_name = Window.partitionBy("scene_id").orderBy("name", "image_id")
    some = images.withColumn("_at", F.row_number().over(by_name) - 1).where(F.col("_at") % stride == 0)
    labelled = some.join(labels.select("scene_id", "image_id").distinct(), ["scene_id", "image_id"], "left_semi")
    return labelled.withColumn("_at", F.row_number().over(by_name)).where(F.col("_at") <= most).drop("_at")


def label_boxes(labels: DataFrame, poses: DataFrame) -> DataFrame:
    """(BOX, class_id, x0..y1) of labels in pixels of their image."""
    box = G.label_to_xyxy(*[F.col(c) for c in ("xc", "yc", "w", "h")], F.col("width"), F.col("height"))
    rows = labels.join(poses.select("scene_id", "image_id", "width", "height"), ["scene_id", "image_id"])
    return rows.select(*B.BOX, "class_id", *[c.alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"), strict=True)])


def poses_of_frames(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(images, cameras) of frames (scene_id, image_id, matrix camera to world, model, width, height, fx, fy, cx, cy): a camera for each frame."""
    terms = G.c2w_to_w2c(G.whole_matrix(F.col("matrix")))
    turn = [c.alias(n) for c, n in zip(G.rotmat_to_quat(terms[:9]), C.POSE[:4], strict=True)]
    images = frames.select("scene_id", "image_id", F.col("image_id").alias("camera_id"), *turn, *[c.alias(n) for c, n in zip(terms[9:], C.POSE[4:], strict=True)])
    return images, frames.select("scene_id", F.col("image_id").alias("camera_id"), "model", "width", "height", "fx", "fy", "cx", "cy")


def label_points(points: DataFrame, images: DataFrame, cameras: DataFrame, labels: DataFrame, up: DataFrame | None = None, min_points: int = 8, inner: float = 0.12) -> DataFrame:
    """(BOX, class_id, point_id, x, y, z, ox.., gx..): the points of every label, where they are seen from and what is up: scene_up() or the like, else +z. A table."""
    poses = C.poses_with_cameras(images, cameras)
    found = label_boxes(labels, poses)
    inside = B.points_in_boxes(C.visible_projections(points.select("scene_id", "point_id", "x", "y", "z"), poses, reach(found)), found.drop("class_id"), min_points, inner)
    centre = G.camera_center(C.quaternion(), C.translation())
    origins = images.select("scene_id", "image_id", *[c.alias(n) for c, n in zip(centre, ("ox", "oy", "oz"), strict=True)])
    seen = inside.join(origins, ["scene_id", "image_id"]).join(found.select(*B.BOX, "class_id"), list(B.BOX))
    if up is None:
        seen = seen.withColumns({"gx": F.lit(0.0), "gy": F.lit(0.0), "gz": F.lit(1.0)})
    else:
        seen = seen.join(up.select("scene_id", *[F.col(c).alias(f"g{c}") for c in "xyz"]), "scene_id")
    return written(seen.select(*B.BOX, "class_id", "point_id", *"xyz", "ox", "oy", "oz", "gx", "gy", "gz"))


def lifted_boxes(points: DataFrame, images: DataFrame, cameras: DataFrame, labels: DataFrame, up: DataFrame | None = None, min_points: int = 8, inner: float = 0.12) -> DataFrame:
    """(BOX, class_id, cx.., half_f.., axes, points): a box for each label that holds points enough."""
    poses = C.poses_with_cameras(images, cameras)
    found = label_boxes(labels, poses)
    fitted = B.box_contents(points.select("scene_id", "point_id", "x", "y", "z"), poses, found.drop("class_id"), min_points, inner, up=up, fit=True, margin=reach(found))
    return fitted.drop("depth", "ids").withColumnRenamed("n", "points").join(found.select(*B.BOX, "class_id"), list(B.BOX))


def reach(found: DataFrame) -> float:
    """The margin about the frame within which all boxes lie."""
    ends = found.agg(F.max(F.greatest(-F.col("x0"), -F.col("y0"), F.lit(0.0))), F.max(F.greatest("x1", "y1"))).first()
    return 1.0 + max(ends[0] or 0.0, 0.0) if ends[1] is not None else 1.0


def merged_labels(seen: DataFrame, distance: float) -> DataFrame:
    """seen, as label_points() makes it, with object: the number of the object of its class that each label was merged into, in order of image and label."""
    ordinal = F.col("image_id") * 100_000 + F.col("ordinal")
    boxes = B.fit_obb_view(seen, [*B.BOX, "class_id"]).select(*B.BOX, "class_id", "cx", "cy", "cz")
    held = seen.groupBy(*B.BOX, "class_id").agg(*[F.first(c).alias(c) for c in ("ox", "oy", "oz", "gx", "gy", "gz")], F.collect_list(F.struct(*"xyz")).alias("points"))
    observed = held.join(boxes, [*B.BOX, "class_id"]).withColumns({"class_id": F.col("class_id").cast("int"), "ordinal": ordinal})
    given = B.merge_objects(observed, distance).withColumnRenamed("ordinal", "_at").withColumnRenamed("merged", "object")
    return seen.withColumn("_at", ordinal).join(given, ["scene_id", "class_id", "_at"]).drop("_at")


def merged_boxes(points: DataFrame, images: DataFrame, cameras: DataFrame, labels: DataFrame, up: DataFrame | None = None, distance: float = 0.6, min_points: int = 8, inner: float = 0.12, most: int = HELD) -> DataFrame:
    """(BOX, class_id, object): the object of its class that each label with points enough is merged into, in order of image and label.

    Scenes of at most `most` points go by merged_digests(), which makes no row for a point in a box; larger ones by label_points().
    """
    light, heavy = parted(points, images, cameras, labels, up, min_points, inner, most)
    given = merged_digests(*light, min_points, 10.0, distance, False)
    kinds = {**dict(labels.dtypes), "object": "bigint"}
    rows = [given] if heavy is None else [given, merged_labels(heavy, distance).select(*given.columns).distinct()]
    return reduce(DataFrame.unionByName, [r.select(*[F.col(c).cast(kinds[c]).alias(c) for c in (*B.BOX, "class_id", "object")]) for r in rows])


def parted(points: DataFrame, images: DataFrame, cameras: DataFrame, labels: DataFrame, up: DataFrame | None, min_points: int, inner: float, most: int) -> tuple[tuple[DataFrame, DataFrame], DataFrame | None]:
    """((points, boxes as merged_digests() takes them) of scenes of at most `most` points, label_points() of the others or None without any)."""
    points, poses = points.select("scene_id", "point_id", "x", "y", "z"), C.poses_with_cameras(images, cameras)
    found = label_boxes(labels, poses)
    placed = B.placed_boxes(poses, B.shrink(found, inner).join(found.select(*B.BOX, "class_id"), list(B.BOX)), up, True)[0]
    heavy = B.heavy_scenes(points, most)
    if heavy.isEmpty():
        return (points, placed), None
    heavy = F.broadcast(written(heavy))
    less = [df.join(heavy, "scene_id", "left_anti") for df in (points, placed)]
    return (less[0], less[1]), label_points(*[df.join(heavy, "scene_id", "left_semi") for df in (points, images)], cameras, labels, up, min_points, inner)


def lifted_objects(points: DataFrame, images: DataFrame, cameras: DataFrame, labels: DataFrame, up: DataFrame | None, distance: float, min_points: int, inner: float, captures: DataFrame | None, most: int) -> DataFrame:
    """The rows of lift_scene() by one set of cameras."""
    (light, placed), heavy = parted(points, images, cameras, labels, up, min_points, inner, most)
    moves = None if captures is None else captures.select("scene_id", "matrix", *[F.col(c).alias(f"_u{c}") for c in "xyz"])
    matrix = G.whole_matrix(F.col("matrix"))
    turned = G.rotate([F.get(matrix, F.lit(k)) for k in (0, 1, 2, 4, 5, 6, 8, 9, 10)], [F.col(f"_u{c}") for c in "xyz"])
    ups = [F.coalesce(t / (G.norm(turned) + 1e-12), F.col(f"g{c}")) for c, t in zip("xyz", turned, strict=True)]
    same = [float(k % 5 == 0) for k in range(12)]
    if moves is None:
        placed = placed.withColumns({**{n: F.lit(x) for n, x in zip(MOVE, same, strict=True)}, **{f"h{c}": F.col(f"g{c}") for c in "xyz"}})
    else:
        placed = placed.join(moves, "scene_id", "left").withColumns({**{n: F.coalesce(F.get(matrix, F.lit(k)), F.lit(x)) for k, (n, x) in enumerate(zip(MOVE, same, strict=True))}, **{f"h{c}": u for c, u in zip("xyz", ups, strict=True)}}).drop("matrix", "_ux", "_uy", "_uz")
    digests = merged_digests(light, placed, min_points, 10.0, distance, True)
    digests = digests.withColumn("class_id", F.col("class_id").cast(labels.schema["class_id"].dataType))
    if heavy is None:
        return digests
    given = merged_labels(heavy, distance)
    if moves is not None:
        moved = {n: c for names in ("xyz", ("ox", "oy", "oz")) for n, c in zip(names, G.apply_capture_transform([F.col(n) for n in names], F.col("matrix")), strict=True)}
        given = given.join(moves, "scene_id", "left").withColumns({**moved, **{f"g{c}": u for c, u in zip("xyz", ups, strict=True)}}).drop("matrix", "_ux", "_uy", "_uz")
    rows, key = written(given), ["scene_id", "class_id", "object"]
    counts = rows.groupBy(*key).agg(F.count_distinct("image_id", "ordinal").alias("observations"))
    return digests.unionByName(B.fit_obb_view(rows, key).join(counts, key).select(*digests.columns))


def lift_scene(
    points: DataFrame, images: DataFrame, cameras: DataFrame, labels: DataFrame, up: DataFrame | None = None, distance: float = 0.6, min_points: int = 8, inner: float = 0.12, frames: DataFrame | None = None,
    captures: DataFrame | None = None, most: int = HELD,
) -> DataFrame:
    """(scene_id, class_id, object, cx, cy, cz, half_f, half_r, half_u, axes, points, observations): labels lifted to boxes and merged; see merged_boxes().

    Scenes that frames (as for poses_of_frames()) has are lifted by those cameras, with up as their mean; the others by the
    registered images, with the given up or +z. Where captures (scene_id, matrix, x, y, z) has a scene of the latter, its
    objects' points and origins go through the matrix and are fitted again with x, y, z turned by it as up.
    """
    found = []
    if frames is not None:
        own, terms = poses_of_frames(frames)
        found.append(lifted_objects(points, own, terms, labels, C.scene_up(own), distance, min_points, inner, None, most))
        images = images.join(frames.select("scene_id").distinct(), "scene_id", "left_anti")
    found.append(lifted_objects(points, images, cameras, labels, up, distance, min_points, inner, captures, most))
    return reduce(DataFrame.unionByName, found)


def lift_debug(points: DataFrame, images: DataFrame, cameras: DataFrame, labels: DataFrame, up: DataFrame | None = None, min_points: int = 8, inner: float = 0.12) -> DataFrame:
    """(BOX, class_id, points, iou): a row for each label, how many points its box was fitted on (null: not lifted), and how far the box
    projected back overlaps the label."""
    poses = C.poses_with_cameras(images, cameras)
    boxes = written(lifted_boxes(points, images, cameras, labels, up, min_points, inner))
    axes = [F.col(f"{a}{c}") for c in "xyz" for a in "fru"]
    turned = boxes.select(*B.BOX, "class_id", "points", "cx", "cy", "cz", *[x.alias(f"r{k}") for k, x in enumerate(axes)], *[F.col(f"half_{a}").alias(n) for a, n in zip("fru", ("hx", "hy", "hz"), strict=True)])
    corner = G.obb_corner([F.col(c) for c in ("cx", "cy", "cz")], [F.col(f"r{k}") for k in range(9)], [F.col(c) for c in ("hx", "hy", "hz")], F.col("_k"))
    corners = turned.select("*", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_k")).select(*B.BOX, "class_id", "points", *[c.alias(n) for c, n in zip(corner, "xyz", strict=True)])
    placed = C.projected(corners.join(C.turned(poses), ["scene_id", "image_id"]), ["scene_id", "ordinal", "class_id", "points"])
    spans = placed.groupBy(*B.BOX, "class_id", "points", "width", "height").agg(F.bool_or(F.col("depth") <= 1e-4).alias("_behind"), *[f(c).alias(f"_{c}{n}") for c in "uv" for f, n in ((F.min, 0), (F.max, 1))])
    w, h = F.col("width"), F.col("height")
    gone = F.col("_behind") | (F.col("_u1") < 0) | (F.col("_v1") < 0) | (F.col("_u0") >= w) | (F.col("_v0") >= h)
    back = [G.clip(F.col("_u0"), 0.0, w - 1.0), G.clip(F.col("_v0"), 0.0, h - 1.0), G.clip(F.col("_u1"), 0.0, w - 1.0), G.clip(F.col("_v1"), 0.0, h - 1.0)]
    shown = spans.select(*B.BOX, "points", *[F.when(~gone, c).alias(f"_{n}") for c, n in zip(back, ("x0", "y0", "x1", "y1"), strict=True)])
    rows = label_boxes(labels, poses).join(shown, list(B.BOX), "left")
    overlap = G.box_iou([F.col(c) for c in ("x0", "y0", "x1", "y1")], [F.col(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    return rows.select(*B.BOX, "class_id", "points", F.when(F.col("points").isNotNull(), F.coalesce(F.when(F.col("_x0").isNotNull(), overlap), F.lit(0.0))).alias("iou"))


def point_colors(selected: DataFrame, samples: DataFrame, own: DataFrame) -> DataFrame:
    """selected (scene_id, instance_id, point_id) with r, g, b: the mean of what the voting views show (samples: scene_id, instance_id,
    point_id, r, g, b), cut to whole numbers, else the point's own colour (own: scene_id, point_id, r, g, b), else UNSEEN.

    Where no selected point of an instance was sampled, all have their own colour.
    """
    mean = samples.groupBy("scene_id", "instance_id", "point_id").agg(*[F.floor(F.avg(c)).alias(f"_{c}") for c in "rgb"])
    rows = selected.join(mean, ["scene_id", "instance_id", "point_id"], "left").join(own.select("scene_id", "point_id", *[F.col(c).alias(f"_o{c}") for c in "rgb"]), ["scene_id", "point_id"], "left")
    return rows.select(*selected.columns, *[F.coalesce(F.col(f"_{c}"), F.col(f"_o{c}"), F.lit(UNSEEN)).cast("int").alias(c) for c in "rgb"])


def voted_object_points(points: DataFrame, projected: DataFrame, pixels: DataFrame, min_votes: int = 2) -> DataFrame:
    """(scene_id, instance_id, point_id, x, y, z, votes): the points that an instance's masks vote for, and of these the dense core.

    projected: visible_projections() with frame; pixels: masks as pixel rows.
    """
    return voted_core(points, K.mask_votes(projected, pixels), min_votes)


def voted_core(points: DataFrame, votes: DataFrame, min_votes: int = 2) -> DataFrame:
    """voted_object_points() of votes that are counted: a table, as it is read more than once."""
    chosen = K.select_voted_points(votes, min_votes)
    located = chosen.join(points.select("scene_id", "point_id", "x", "y", "z"), ["scene_id", "point_id"])
    return dense_core(located, ["scene_id", "instance_id"]).select("scene_id", "instance_id", "point_id", "x", "y", "z", "votes")


def opaque_points(gaussians: DataFrame, min_opacity: float = 0.3) -> DataFrame:
    """Gaussians that can stand for a surface."""
    return gaussians.where(F.col("opacity") >= min_opacity)


def filter_packed(gaussians: DataFrame, keep: Column, width: int, packed: str = "sh") -> DataFrame:
    """The Gaussians to keep with their packed coefficients; an error where a row has not `width` of them."""
    whole = F.when(F.size(packed) == width, F.col(packed)).otherwise(F.raise_error(F.lit(f"{packed} does not hold {width} numbers")).cast(gaussians.schema[packed].dataType))
    return gaussians.where(keep).withColumn(packed, whole)
