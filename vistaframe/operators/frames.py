"""Coordinate frames: floor planes, alignment, and paths through a graph of transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaframe.functions.geometry import clip, cross, dot, eigh3, norm, rotation_to_up
from vistaframe.operators.quantiles import quantiles
from vistaframe.sources.tables import written

#: Random triples, how near a point is to count, how level a plane must be, and the fewest points.
HYPOTHESES, NEAR, LEVEL, LEAST_POINTS = 800, 0.04, 0.75, 32
#: Rounds of paths after which all that is found is written as one table.
ROUNDS = 16
#: The fewest inliers that refine a plane.
LEAST_INLIERS = 16


def _drawn(points: DataFrame, draw: int, n: int) -> DataFrame:
    """n points of each scene, the first by 60 bits of a hash of draw and id: kept by threshold first, so that no scene is sorted whole."""
    sizes = points.groupBy("scene_id").agg(F.count(F.lit(1)).alias("_n"))
    order = F.conv(F.substring(F.md5(F.concat(F.lit(f"{draw}:"), F.col("point_id").cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")
    hashed = points.join(F.broadcast(sizes), "scene_id").withColumn("_h", order)
    # About twice as many as asked for pass the threshold.
    few = hashed.where((F.col("_n") <= 4 * n) | (F.col("_h") / float(1 << 60) <= 2.0 * n / F.col("_n")))
    return few.withColumn("_at", F.row_number().over(Window.partitionBy("scene_id").orderBy("_h", "point_id"))).where(F.col("_at") <= n)


def fit_floor(points: DataFrame, ups: DataFrame, hypotheses: int = HYPOTHESES, near: float = NEAR, level: float = LEVEL, seed: int = 0) -> DataFrame:
    """(scene_id, nx, ny, nz, offset, inliers, ratio): the plane with most points near it among those through three low points.

    Candidates are points up to the 20th percentile of height along up (all if those are fewer than 16). Triples are drawn by
    hash, so the result doesn't depend on partitions. Planes steeper than `level` are dropped; normals point up. All planes are
    scored on all points; ties go to the lower plane. The best is refined by its inliers, see _refined(). Scenes with fewer than
    LEAST_POINTS points or without a level plane have no row.
    """
    up = [F.col(f"up_{c}") for c in "xyz"]
    named = points.select("scene_id", "point_id", "x", "y", "z").join(F.broadcast(ups.select("scene_id", *[F.col(c).alias(f"up_{c}") for c in "xyz"])), "scene_id")
    raised = named.withColumn("_height", dot([F.col(c) for c in "xyz"], up))
    cut = quantiles(raised, ["scene_id"], {"_height": [0.2]}).select("scene_id", F.element_at("_height", 1).alias("_cut"), F.col("n").alias("_all")).where(F.col("_all") >= LEAST_POINTS)
    low = raised.join(F.broadcast(cut), "scene_id").withColumn("_low", F.col("_height") <= F.col("_cut"))
    lows = low.groupBy("scene_id").agg(F.count_if("_low").alias("_lows"))
    candidates = low.join(F.broadcast(lows), "scene_id").where(F.col("_low") | (F.col("_lows") < 16)).select("scene_id", "point_id", "x", "y", "z", *[f"up_{c}" for c in "xyz"])
    corner = lambda k: F.struct("x", "y", "z").alias(f"p{k}")
    draw = lambda k: _drawn(candidates, seed * 3 + k, hypotheses)
    triples = draw(0).select("scene_id", "_at", corner(0), *[f"up_{c}" for c in "xyz"])
    for k in (1, 2):
        triples = triples.join(draw(k).select("scene_id", "_at", corner(k)), ["scene_id", "_at"])
    p = [[F.col(f"p{k}.{c}") for c in "xyz"] for k in range(3)]
    n = cross([a - b for a, b in zip(p[1], p[0], strict=True)], [a - b for a, b in zip(p[2], p[0], strict=True)])
    planes = triples.select("scene_id", "_at", *[c.alias(f"n{k}") for k, c in zip("xyz", n, strict=True)], *[f"up_{c}" for c in "xyz"], "p0", "p1", "p2")
    length = norm([F.col(f"n{c}") for c in "xyz"])
    # Triples on a line have no plane; the divisor guards them wherever the filter is evaluated.
    planes = planes.where(length > 1e-12)
    length = F.greatest(length, F.lit(1e-12))
    slope = dot([F.col(f"n{c}") for c in "xyz"], up) / length
    planes = planes.withColumn("_slope", slope).where(F.abs("_slope") >= level)
    sign = F.when(F.col("_slope") < 0, -1.0).otherwise(1.0)
    planes = planes.select("scene_id", "_at", *[(F.col(f"n{c}") / length * sign).alias(f"n{c}") for c in "xyz"], "p0", "p1", "p2")
    heights = [dot([F.col(f"n{c}") for c in "xyz"], corner_) for corner_ in p]
    planes = planes.select("scene_id", "_at", "nx", "ny", "nz", F.element_at(F.array_sort(F.array(*heights)), 2).alias("offset"))

    def scored(rows: DataFrame, of: DataFrame) -> DataFrame:
        inside = F.abs(dot([F.col(c) for c in "xyz"], [F.col(f"n{c}") for c in "xyz"]) - F.col("offset")) < near
        counts = rows.select("scene_id", "x", "y", "z").join(F.broadcast(of), "scene_id").where(inside).groupBy("scene_id", "_at").agg(F.count(F.lit(1)).alias("inliers"))
        return of.join(counts, ["scene_id", "_at"])

    best = Window.partitionBy("scene_id").orderBy(F.col("inliers").desc(), "offset", "_at")
    won = written(scored(named, planes).withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank"))
    final = _refined(named, won, near, level)
    return final.join(cut, "scene_id").select("scene_id", "nx", "ny", "nz", "offset", "inliers", (F.col("inliers") / F.col("_all")).alias("ratio"))


def _refined(points: DataFrame, planes: DataFrame, near: float, level: float) -> DataFrame:
    """planes with the direction in which their inliers (LEAST_INLIERS at least) spread least as normal, the median of the inliers
    along it as offset, and inliers counted again; as they were where that is steeper than `level`. points have up_x..up_z.

    Sums are of decimals inside the inliers' box, so that they don't depend on partitions.
    """
    normal = [F.col(f"n{c}") for c in "xyz"]
    position = [F.col(c) for c in "xyz"]
    inside = points.join(F.broadcast(planes), "scene_id").where(F.abs(dot(position, normal) - F.col("offset")) < near).select("scene_id", *"xyz")
    box = inside.groupBy("scene_id").agg(*[((F.min(c) + F.max(c)) / 2).alias(f"m{c}") for c in "xyz"], F.greatest(F.lit(1e-12), *[(F.max(c) - F.min(c)) / 2 for c in "xyz"]).alias("_s"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= LEAST_INLIERS)
    exact = lambda c: c.cast("decimal(28,20)")
    unit = inside.join(F.broadcast(box), "scene_id").select("scene_id", "_n", *[((F.col(c) - F.col(f"m{c}")) / F.col("_s")).alias(c) for c in "xyz"])
    pairs = ["xx", "xy", "xz", "yy", "yz", "zz"]
    sums = unit.groupBy("scene_id", "_n").agg(*[F.sum(exact(F.col(c))).cast("double").alias(f"s{c}") for c in "xyz"], *[F.sum(exact(F.col(p[0]) * F.col(p[1]))).cast("double").alias(f"s{p}") for p in pairs])

    mean = {c: F.col(f"s{c}") / F.col("_n") for c in "xyz"}
    spread = [F.col(f"s{p}") / F.col("_n") - mean[p[0]] * mean[p[1]] for p in ("xx", "yy", "zz", "xy", "xz", "yz")]
    axis = sums.select("scene_id", F.get(eigh3(spread), F.lit(0)).getField("vector").alias("_v"))
    turned = axis.select("scene_id", *[F.get("_v", F.lit(k)).alias(f"r{c}") for k, c in enumerate("xyz")])
    ups = points.groupBy("scene_id").agg(*[F.first(f"up_{c}").alias(f"up_{c}") for c in "xyz"])
    slope = dot([F.col(f"r{c}") for c in "xyz"], [F.col(f"up_{c}") for c in "xyz"])
    turned = turned.join(F.broadcast(ups), "scene_id").withColumn("_slope", slope).where(F.abs("_slope") >= level)
    turned = written(turned.select("scene_id", *[(F.col(f"r{c}") * F.when(F.col("_slope") < 0, -1.0).otherwise(1.0)).alias(f"n{c}") for c in "xyz"]))
    along = inside.join(turned, "scene_id").select("scene_id", dot(position, normal).alias("_along"))
    middle = quantiles(along, ["scene_id"], {"_along": [0.5]}).select("scene_id", F.element_at("_along", 1).alias("offset"))
    middle = written(turned.join(middle, "scene_id").select("scene_id", "nx", "ny", "nz", "offset"))
    counts = points.join(F.broadcast(middle), "scene_id").where(F.abs(dot(position, normal) - F.col("offset")) < near).groupBy("scene_id").agg(F.count(F.lit(1)).alias("inliers"))
    better = middle.join(counts, "scene_id", "left").select("scene_id", "nx", "ny", "nz", "offset", F.coalesce("inliers", F.lit(0)).alias("inliers"))
    kept = planes.join(F.broadcast(better), "scene_id", "left_anti").select(better.columns)
    return better.unionByName(kept)


def floor_report(points: DataFrame, centres: DataFrame, planes: DataFrame) -> DataFrame:
    """For each scene: the share of points below its plane, the share of cameras above it (1 without cameras), percentiles of height."""
    normal = [F.col(f"n{c}") for c in "xyz"]
    height = dot([F.col(c) for c in "xyz"], normal) - F.col("offset")
    small = planes.select("scene_id", "nx", "ny", "nz", "offset")
    raised = points.join(small, "scene_id").select("scene_id", height.alias("_p"))
    spread = quantiles(raised, ["scene_id"], {"_p": [0.01, 0.05, 0.5, 0.95, 0.99]}).drop("n")
    below = raised.groupBy("scene_id").agg(F.avg(F.when(F.col("_p") < -NEAR, 1.0).otherwise(0.0)).alias("below")).join(spread, "scene_id")
    above = centres.join(small, "scene_id").groupBy("scene_id").agg(F.avg(F.when(height > 0, 1.0).otherwise(0.0)).alias("above"))
    return below.join(above, "scene_id", "left").select("scene_id", "below", F.coalesce("above", F.lit(1.0)).alias("cameras_above"), *[F.element_at("_p", k).alias(n) for k, n in enumerate(("z1", "z5", "z50", "z95", "z99"), 1)])


def floor_to_world(points: DataFrame, planes: DataFrame) -> DataFrame:
    """(scene_id, matrix): turns the plane's normal to +z, puts the plane at 0 and the median point over the origin."""
    r = rotation_to_up([F.col(f"n{c}") for c in "xyz"])
    turned = points.join(planes, "scene_id")
    xy = [dot(r[3 * k : 3 * k + 3], [F.col(c) for c in "xyz"]) for k in (0, 1)]
    middle = quantiles(turned.select("scene_id", xy[0].alias("_x"), xy[1].alias("_y")), ["scene_id"], {"_x": [0.5], "_y": [0.5]}).select("scene_id", F.element_at("_x", 1).alias("_x"), F.element_at("_y", 1).alias("_y"))
    shift = [-F.col("_x"), -F.col("_y"), -F.col("offset")]
    terms = [t for k in range(3) for t in (*r[3 * k : 3 * k + 3], shift[k])]
    return planes.join(middle, "scene_id").select("scene_id", F.array(*[t + 0.0 for t in terms], *[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)]).alias("matrix"))


def alignment_confidence(ratio: Column) -> Column:
    return clip(1.5 * ratio, 0.0, 1.0)


def rigid_inverse(m: Column) -> Column:
    """The inverse of a similarity's 4x4 matrix: the transposed rotation over the squared scale."""
    g = lambda i, j: F.get(m, F.lit(4 * i + j))
    square = g(0, 0) * g(0, 0) + g(1, 0) * g(1, 0) + g(2, 0) * g(2, 0)
    rows = []
    for j in range(3):
        turned = [g(i, j) / square for i in range(3)]
        rows += [*turned, -dot(turned, [g(i, 3) for i in range(3)])]
    return F.array(*rows, *[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)])


def frame_paths(edges: DataFrame) -> DataFrame:
    """(scene_id, source, target, hops, matrix): the shortest path between all frames of a scene that transforms link.

    edges: scene_id, ordinal, source, target, matrix (similarities), walked in both directions. A frame reaches itself by the
    identity. Of paths with equal hops the one of earlier edges wins. Rounds go on until one finds no new pair: as many as the
    longest shortest path has hops. Frames of a scene are few, so a path set is too.
    """
    from vistaframe.functions.geometry import matmul44

    both = edges.select("scene_id", "ordinal", "source", "target", "matrix").unionByName(edges.select("scene_id", "ordinal", F.col("target").alias("source"), F.col("source").alias("target"), rigid_inverse(F.col("matrix")).alias("matrix")))
    identity = F.array(*[F.lit(1.0 if k % 5 == 0 else 0.0) for k in range(16)])
    frames = both.select("scene_id", F.col("source").alias("frame")).distinct()
    found = frames.select("scene_id", F.col("frame").alias("source"), F.col("frame").alias("target"), F.lit(0).alias("hops"), F.array().cast("array<long>").alias("edges"), identity.alias("matrix"))
    step = both.select("scene_id", F.col("source").alias("_via"), F.col("ordinal").alias("_edge"), F.col("target").alias("_to"), F.col("matrix").alias("_next"))
    step, found = written(step), written(found)
    front, before, hops = found, found.limit(0), 0
    while True:
        hops += 1
        grown = front.join(step, (front["scene_id"] == step["scene_id"]) & (front["target"] == step["_via"])).select(front["scene_id"], "source", F.col("_to").alias("target"), F.lit(hops).alias("hops"), F.concat("edges", F.array(F.col("_edge").cast("long"))).alias("edges"), matmul44(F.col("_next"), F.col("matrix")).alias("matrix"))
        shortest = grown.groupBy("scene_id", "source", "target").agg(F.min_by(F.struct("hops", "edges", "matrix"), "edges").alias("_p")).select("scene_id", "source", "target", "_p.*")
        # As edges go both ways, what was found earlier can only be of this front or of the one before.
        late = front.unionByName(before).select("scene_id", "source", "target")
        before, front = front, written(shortest.join(late, ["scene_id", "source", "target"], "left_anti"))
        if front.isEmpty():
            break
        found = found.unionByName(front)
        if hops % ROUNDS == 0:
            found = written(found)
    return found.drop("edges")


def floor_gate(reports: DataFrame, most_below: float = 1.0, least_ratio: float = 0.0, least_above: float = 0.9) -> DataFrame:
    """reports (scene_id, below, cameras_above, ratio and others) with problem: the first of what is wrong with a floor, or null.

    below: more of the points than most_below lie under it, it floats; ratio: too few points lie on it; cameras: more than
    the rest of least_above of the cameras lie under it.
    """
    floating = F.when(F.col("below") > most_below, "below")
    thin = F.when(F.col("ratio") < least_ratio, "ratio")
    ceiling = F.when(F.col("cameras_above") < least_above, "cameras")
    return reports.withColumn("problem", F.coalesce(floating, thin, ceiling))


def align_scene(points: DataFrame, images: DataFrame, strict: bool = True, most_below: float = 1.0, least_ratio: float = 0.0, seed: int = 0) -> DataFrame:
    """(scene_id, matrix, confidence, below, cameras_above, ratio, problem): up, floor, matrix, report and gate of each scene.

    strict: a problem is an error. Scenes without a floor (see fit_floor()) have no row.
    """
    from vistaframe.operators import cameras as C

    from vistaframe.functions import geometry as G

    planes = written(fit_floor(points, C.scene_up(images), seed=seed))
    centres = images.select("scene_id", *[c.alias(n) for c, n in zip(G.camera_center(C.quaternion(), C.translation()), "xyz", strict=True)])
    report = floor_report(points, centres, planes).join(planes.select("scene_id", "ratio"), "scene_id")
    gated = floor_gate(report, most_below, least_ratio)
    if strict:
        wrong = F.raise_error(F.concat(F.lit("floor of scene "), F.col("scene_id"), F.lit(" fails: "), F.col("problem"))).cast("string")
        gated = gated.withColumn("problem", F.when(F.col("problem").isNotNull(), wrong))
    rows = floor_to_world(points, planes).join(gated, "scene_id")
    return rows.select("scene_id", "matrix", alignment_confidence(F.col("ratio")).alias("confidence"), "below", "cameras_above", "ratio", "problem")
