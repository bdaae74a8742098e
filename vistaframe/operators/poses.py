"""Camera paths: interpolation between poses, novel poses, synthetic labels; and boxes by principal axes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaframe.functions import geometry as G
from vistaframe.operators.quantiles import quantiles

POSE = ("qw", "qx", "qy", "qz", "px", "py", "pz")


def numbered(poses: DataFrame, order: str) -> DataFrame:
    """poses with at: their place in the scene from 0. Poses are few, points are not."""
    return poses.withColumn("at", F.row_number().over(Window.partitionBy("scene_id").orderBy(order)) - 1)


def interpolate_poses(poses: DataFrame, alphas: DataFrame, order: str) -> DataFrame:
    """(scene_id, alpha, POSE): the pose at each alpha (0 to 1, clipped) along the poses of its scene in order.

    Positions are mixed, rotations turned along the shorter arc, between the two poses around it.
    """
    known = numbered(poses, order).select("scene_id", "at", *POSE)
    counts = known.groupBy("scene_id").agg(F.count(F.lit(1)).alias("_n"))
    place = G.clip(F.col("alpha"), 0.0, 1.0) * (F.col("_n") - 1)
    rows = alphas.join(counts, "scene_id").withColumn("_place", place).withColumn("_i", F.floor("_place"))
    rows = rows.select(*alphas.columns, F.col("_i").alias("at"), F.least(F.col("_i") + 1, F.col("_n") - 1).alias("_next"), (F.col("_place") - F.col("_i")).alias("_u"))
    after = known.select("scene_id", F.col("at").alias("_next"), *[F.col(c).alias(f"_{c}") for c in POSE])
    both = rows.join(known, ["scene_id", "at"]).join(after, ["scene_id", "_next"])
    u = F.col("_u")
    turned = G.slerp([F.col(c) for c in POSE[:4]], [F.col(f"_{c}") for c in POSE[:4]], u)
    moved = [F.col(c) * (1 - u) + F.col(f"_{c}") * u for c in POSE[4:]]
    return both.select(*alphas.columns, *[x.alias(c) for x, c in zip([*turned, *moved], POSE, strict=True)])


def uniform(seed: int, *parts: Column) -> Column:
    """A number from 0 to 1 by hash: the same on any partitioning."""
    return (F.xxhash64(F.lit(seed), *parts).bitwiseAND((1 << 53) - 1)).cast("double") / float(1 << 53)


def gaussian(seed: int, *parts: Column) -> Column:
    return F.sqrt(-2 * F.log(F.greatest(uniform(seed, *parts), F.lit(1e-300)))) * F.cos(2 * np.pi * uniform(seed + 1, *parts))


def sample_novel_poses(poses: DataFrame, n: int, order: str, position_sigma: float = 0.0, seed: int = 0) -> DataFrame:
    """n poses of each scene along its path, evenly spaced, with Gaussian shifts drawn by hash; the poses themselves where there are fewer than two."""
    counts = poses.groupBy("scene_id").agg(F.count(F.lit(1)).alias("_n"))
    many = counts.where("_n >= 2").select("scene_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("ordinal")).withColumn("alpha", F.col("ordinal") / float(max(1, n - 1)))
    path = interpolate_poses(poses, many, order)
    shift = [(F.col(c) + position_sigma * gaussian(seed + 10 * k, F.col("scene_id"), F.col("ordinal"))).alias(c) for k, c in enumerate(POSE[4:], 1)]
    found = path.select("scene_id", "ordinal", *POSE[:4], *shift)
    few = numbered(poses, order).join(counts.where("_n < 2"), "scene_id", "left_semi").select("scene_id", F.col("at").alias("ordinal"), *POSE)
    return found.unionByName(few)


def fit_obb_pca(points: DataFrame, key: list[str], pct: float = 5.0) -> DataFrame:
    """Centre, half sides and axes of a box along each key's principal axes; along x, y, z with fewer than three points.

    Axes go by falling variance; the first two point along their largest component, the third completes a right-handed frame.
    Covariances are aggregates about each key's mean, and their axes are columns (eigh3()).
    """
    pairs = [("x", "x"), ("y", "y"), ("z", "z"), ("x", "y"), ("x", "z"), ("y", "z")]
    sums = points.groupBy(*key).agg(F.count(F.lit(1)).alias("points"), *[F.avg(c).alias(f"m{c}") for c in "xyz"], *[F.covar_samp(a, b).alias(f"v{a}{b}") for a, b in pairs])
    # Fewer than three points have no plane, so their box is upright: a diagonal matrix gives it.
    upright = [F.lit(v) for v in (3.0, 2.0, 1.0, 0.0, 0.0, 0.0)]
    spread = [F.when(F.col("points") >= 3, F.coalesce(f"v{a}{b}", F.lit(0.0))).otherwise(u) for (a, b), u in zip(pairs, upright, strict=True)]
    solved = sums.withColumn("_e", G.eigh3(spread))
    first, second = ([F.get(F.get("_e", F.lit(k)).getField("vector"), F.lit(c)) for c in range(3)] for k in (2, 1))
    axes = [f"a{k}{c}" for k in range(3) for c in "xyz"]
    turned = solved.select(*key, "points", "mx", "my", "mz", *[v.alias(a) for v, a in zip([*first, *second, *G.cross(first, second)], axes, strict=True)])
    part = lambda k: sum((F.col(c) - F.col(f"m{c}")) * F.col(f"a{k}{c}") for c in "xyz")
    local = points.join(turned, key).select(*key, *[part(k).alias(f"l{k}") for k in range(3)])
    spans = quantiles(local, key, {f"l{k}": [pct / 100, 1 - pct / 100] for k in range(3)}).select(*key, *[F.col(f"l{k}").alias(f"p{k}") for k in range(3)])
    middle = [(F.element_at(f"p{k}", 1) + F.element_at(f"p{k}", 2)) / 2 for k in range(3)]
    centre = [(F.col(f"m{c}") + sum(middle[k] * F.col(f"a{k}{c}") for k in range(3))).alias(f"c{c}") for c in "xyz"]
    half = [F.greatest((F.element_at(f"p{k}", 2) - F.element_at(f"p{k}", 1)) / 2, F.lit(1e-3)).alias(f"half{k}") for k in range(3)]
    return turned.join(spans, key).select(*key, "points", *centre, *half, *axes)
