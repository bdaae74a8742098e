"""Poses, cameras and which camera sees which point."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaframe.functions import geometry as G
from vistaframe.operators.held import BLOCK, SPREAD, view_sums
from vistaframe.sources.tables import written

POSE = ("qw", "qx", "qy", "qz", "tx", "ty", "tz")


def quaternion() -> list[Column]:
    return [F.col(c) for c in POSE[:4]]


def translation() -> list[Column]:
    return [F.col(c) for c in POSE[4:]]


def xyz(prefix: str = "") -> list[Column]:
    return [F.col(prefix + c) for c in "xyz"]


def poses_with_cameras(images: DataFrame, cameras: DataFrame, strict: bool = False) -> DataFrame:
    """Images with the terms of their camera. An image of an unknown camera is skipped, or an error if strict."""
    if not strict:
        return images.join(cameras, ["scene_id", "camera_id"])
    known = images.join(cameras, ["scene_id", "camera_id"], "left")
    missing = F.raise_error(F.concat(F.lit("no camera "), F.col("camera_id").cast("string"))).cast("string")
    return known.withColumn("model", F.coalesce("model", missing))


TURN = tuple(f"_r{k}" for k in range(9))
TERMS = ("image_id", *TURN, *POSE[4:], "width", "height", "fx", "fy", "cx", "cy")


def turned(poses: DataFrame) -> DataFrame:
    """scene_id and TERMS of poses: rotations as matrices and focal lengths as they apply, so that points meet plain numbers."""
    fx, fy = G.focal_terms(F.col("model"), F.col("fx"), F.col("fy"))
    return poses.select("scene_id", "image_id", *[r.alias(n) for r, n in zip(G.quat_to_rotmat(quaternion()), TURN, strict=True)], *POSE[4:], "width", "height", fx.alias("fx"), fy.alias("fy"), "cx", "cy")


def projected(rows: DataFrame, keep: list[str]) -> DataFrame:
    """keep, image_id, width, height, u, v and depth of rows that hold a point and the TERMS of a pose."""
    camera = [a + b for a, b in zip(G.rotate([F.col(n) for n in TURN], xyz()), translation(), strict=True)]
    u, v, depth = G.pinhole(camera, F.col("fx"), F.col("fy"), F.col("cx"), F.col("cy"))
    return rows.select(*keep, "image_id", "width", "height", u.alias("u"), v.alias("v"), depth.alias("depth"))


CELL = ("scene_id", "_gx", "_gy", "_gz")
#: Points of a cell, about; cells along a scene's side, at most; and parts that a scene's cells are dealt to.
CELL_POINTS, MOST_CELLS, CELL_PARTS = 64, 32, 16


def paired(points: DataFrame, poses: DataFrame) -> DataFrame:
    """Every point with every row of poses of its scene. Points are dealt to parts of their scene, with a copy of the poses each, so
    that a scene is many tasks however small its files are; a few bytes make many rows, so parts aren't put together by their
    size and neither side is broadcast."""
    part = F.pmod(F.xxhash64(*[c for c in points.columns if c != "scene_id"]), F.lit(CELL_PARTS)).alias("_part")
    dealt = points.select("*", part).repartition(SPREAD, "scene_id", "_part")
    copies = poses.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(CELL_PARTS - 1).cast("long"))).alias("_part"))
    return dealt.hint("merge").join(copies.repartition(SPREAD, "scene_id", "_part"), ["scene_id", "_part"]).drop("_part")


#: Bits of image ids that the ids of one row of alike() share at most.
ALIKE_BITS = 20


def alike(poses: DataFrame) -> DataFrame:
    """poses with a row for those that differ in image_id only, and images: these ids in order. What a point looks like in them is worked out once.

    A row has at most 2^ALIKE_BITS ids where a scene's are distinct.
    """
    block = F.shiftright("image_id", ALIKE_BITS).alias("_ids")
    return poses.groupBy(*[c for c in poses.columns if c != "image_id"], block).agg(F.sort_array(F.collect_list("image_id")).alias("images")).drop("_ids")


def with_times(poses: DataFrame) -> DataFrame:
    """poses with a row for those that differ in image_id only, and times: how many they are."""
    return poses.groupBy(*[c for c in poses.columns if c != "image_id"]).agg(F.count(F.lit(1)).alias("times"))


def projections(points: DataFrame, poses: DataFrame) -> DataFrame:
    """(scene_id, point_id, image_id, u, v, depth) of every point in every image of its scene, seen or not. poses: from poses_with_cameras().

    Its rows are all points times all images of a scene; visible_projections() has those inside the frames only, and makes
    no more.
    """
    return projected(paired(points, turned(poses)), points.columns)


def with_cells(points: DataFrame, size: int = CELL_POINTS) -> DataFrame:
    """The points at finite places, with the cell of a grid over their scene's extent that holds about size on average."""
    placed = points.where(reduce(and_, [G.finite(c) for c in xyz()]))
    spans = placed.groupBy("scene_id").agg(F.count(F.lit(1)).alias("_n"), *[f(c).alias(f"_{n}{c}") for c in "xyz" for f, n in ((F.min, "lo"), (F.max, "hi"))])
    side = F.least(F.greatest(F.ceil(F.cbrt(F.col("_n") / size)), F.lit(1)), F.lit(MOST_CELLS))
    spans = spans.withColumn("_side", side)
    at = lambda c: F.least(F.floor((F.col(c) - F.col(f"_lo{c}")) / F.nullif(F.col(f"_hi{c}") - F.col(f"_lo{c}"), F.lit(0.0)) * F.col("_side")), F.col("_side") - 1)
    return placed.join(spans, "scene_id").select(*points.columns, *[F.coalesce(at(c), F.lit(0)).cast("int").alias(f"_g{c}") for c in "xyz"])


def cells_in_frames(celled: DataFrame, poses: DataFrame, margin: float, max_depth: float | None) -> DataFrame:
    """CELL, TERMS and whole: the cells that an image may see points of; whole: it surely sees all of them.

    A frustum is a few half-spaces that are linear in the place, so over the box of a cell's points each has its least and
    largest value at once. Both are kept off zero by more than rounding can do; what is near goes on point by point.
    """
    boxes = celled.groupBy(*CELL).agg(*[f(c).alias(f"_{n}{c}") for c in "xyz" for f, n in ((F.min, "lo"), (F.max, "hi"))])
    boxes = boxes.select(*CELL, *[((F.col(f"_lo{c}") + F.col(f"_hi{c}")) / 2).alias(f"_m{c}") for c in "xyz"], *[((F.col(f"_hi{c}") - F.col(f"_lo{c}")) / 2).alias(f"_h{c}") for c in "xyz"])
    boxes = boxes.withColumn("_part", F.pmod(F.xxhash64("_gx", "_gy", "_gz"), F.lit(CELL_PARTS)))
    poses, r, t = turned(poses), [F.col(n) for n in TURN], translation()
    fx, fy = F.col("fx"), F.col("fy")
    right, down, depth = ([*r[k : k + 3], t[k // 3]] for k in (0, 3, 6))
    mix = lambda a, p, b, q: [x * p + y * q for x, y in zip(a, b, strict=True)]
    flat = F.lit(0.0)
    planes = [
        (depth, flat - 1e-6, F.lit(1.0)),
        (mix(right, fx, depth, F.col("cx") + margin), flat, fx),
        (mix(right, -fx, depth, F.col("width") + margin - F.col("cx")), flat, fx),
        (mix(down, fy, depth, F.col("cy") + margin), flat, fy),
        (mix(down, -fy, depth, F.col("height") + margin - F.col("cy")), flat, fy),
    ]
    if max_depth is not None:
        planes.append(([-x for x in depth], flat + max_depth, F.lit(1.0)))
    sides = [c.alias(f"_p{k}{n}") for k, (terms, shift, scale) in enumerate(planes) for c, n in zip([*terms[:3], terms[3] + shift, F.abs(terms[3]) + F.abs(scale) * (1 + F.abs("width") + F.abs("height"))], "xyzts", strict=True)]
    dealt = poses.select("scene_id", *TERMS, *sides).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(CELL_PARTS - 1).cast("long"))).alias("_part"))
    middle, half = ([F.col(f"_{n}{c}") for c in "xyz"] for n in "mh")
    maybe, whole = [], []
    for k in range(len(planes)):
        terms = [F.col(f"_p{k}{c}") for c in "xyz"]
        value = G.dot(terms, middle) + F.col(f"_p{k}t")
        spread = G.dot([F.abs(c) for c in terms], half)
        slack = 1e-9 * (G.dot([F.abs(c) for c in terms], [F.abs(m) + h for m, h in zip(middle, half, strict=True)]) + F.col(f"_p{k}s"))
        maybe.append(value + spread >= -slack)
        whole.append(value - spread > slack)
    near = boxes.join(dealt, ["scene_id", "_part"]).where(reduce(and_, maybe))
    return near.select(*CELL, *TERMS, reduce(and_, whole).alias("whole"))


def in_frame(margin: float, max_depth: float | None) -> Column:
    inside = (F.col("depth") > 1e-6) & (F.col("u") >= -margin) & (F.col("u") < F.col("width") + margin) & (F.col("v") >= -margin) & (F.col("v") < F.col("height") + margin)
    return inside if max_depth is None else inside & (F.col("depth") < max_depth)


def visible_projections(points: DataFrame, poses: DataFrame, margin: float = 1.0, max_depth: float | None = None) -> DataFrame:
    """The rows of projections() that lie in front of the camera and in its frame widened by margin pixels.

    Points meet poses by the cells of a grid that the pose's frustum reaches, so a scene is never joined as a whole and a
    cell's points are spread over tasks as rows. Points that aren't finite are in no frame.
    """
    celled = written(with_cells(points))
    # The join makes many rows of few bytes, so its parts must not be put together by their size before it.
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = cells_in_frames(celled, poses, margin, max_depth).drop("whole").repartition(parts, *CELL)
    return projected(celled.join(near, list(CELL)), points.columns).where(in_frame(margin, max_depth))


def view_counts(points: DataFrame, images: DataFrame, cameras: DataFrame, margin: float = 0.0, max_depth: float | None = None) -> DataFrame:
    """(scene_id, point_id, views): how many cameras of its scene see each point, 0 included.

    A camera sees what is deeper than 1e-6, less deep than max_depth if given, and projects into the half-open frame widened
    by margin pixels. A block of points is held by a task that all images of its scene pass; cells of it that an image sees
    whole are counted as such, and only points at the edges of frusta are projected. Points are shuffled once, images once a block; images
    in equal poses pass as one.
    """
    celled = with_cells(points.select("scene_id", "point_id", "x", "y", "z"), BLOCK)
    counts = view_sums(celled, with_times(turned(poses_with_cameras(images, cameras))), margin, max_depth).groupBy("scene_id", "point_id").agg(F.sum("views").alias("views"))
    return points.select("scene_id", "point_id").join(counts, ["scene_id", "point_id"], "left").withColumn("views", F.coalesce("views", F.lit(0)))


def scene_up(images: DataFrame) -> DataFrame:
    """(scene_id, x, y, z): the mean up direction of a scene's cameras, of length 1; straight up where it has none."""
    up = G.camera_up(quaternion())
    mean = images.groupBy("scene_id").agg(*[F.avg(c).alias(n) for c, n in zip(up, "xyz", strict=True)])
    length = G.norm(xyz())
    return mean.select("scene_id", *[F.when(length > 1e-9, F.col(c) / length).otherwise(float(c == "z")).alias(c) for c in "xyz"])


def registered_image_count(images: DataFrame) -> DataFrame:
    return images.groupBy("scene_id").agg(F.count(F.lit(1)).alias("registered"))


def registration_rate(frames: DataFrame, images: DataFrame, least: float = 0.0) -> DataFrame:
    """Registered images over candidate frames of each scene, 0 without candidates; fails below `least` if that is above 0."""
    candidates = frames.groupBy("scene_id").agg(F.count(F.lit(1)).alias("candidates"))
    both = candidates.join(registered_image_count(images), "scene_id", "left")
    rate = F.coalesce(F.col("registered") / F.nullif(F.col("candidates"), F.lit(0)), F.lit(0.0))
    return both.select("scene_id", F.coalesce("registered", F.lit(0)).alias("registered"), "candidates", rate.alias("rate"), (F.lit(least <= 0) | (rate >= least)).alias("passed"))


def first_poses(images: DataFrame, k: int) -> DataFrame:
    """The first k images of each scene, by name."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("scene_id").orderBy("name", "image_id"))
    return images.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
