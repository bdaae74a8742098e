"""Gates, approvals and settings checks over scene, object, check and artifact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaframe.operators.quantiles import quantiles

#: Keys that an object's physics must have before it is approved.
PHYSICS_KEYS = ("mass_kg", "density_kg_m3", "friction", "restitution", "collider")


def geometry_gate(scenes: DataFrame) -> DataFrame:
    """scenes (build_mode, modality, metric, method) with problem: what keeps a production build from collision geometry, or null."""
    production = F.col("build_mode") == "production"
    unscaled = F.when(production & ~F.col("metric"), "scale")
    unanchored = F.when(production & (F.col("modality") == "rgb") & (F.col("method") == "unknown"), "anchor")
    return scenes.withColumn("problem", F.coalesce(unscaled, unanchored))


def uncovered(least: float) -> Column:
    return F.col("movable") & (F.col("state") == "approved") & (F.col("coverage") < least)


def background_gate(scenes: DataFrame, objects: DataFrame, least: float) -> DataFrame:
    """(scene_id, uncovered, passed): approved movable objects with too little seen behind them; only production scenes without a clean
    plate and without leave to have holes can fail."""
    lacking = objects.where(uncovered(least)).groupBy("scene_id").agg(F.array_sort(F.collect_list("instance_id")).alias("uncovered"))
    rows = scenes.join(lacking, "scene_id", "left").withColumn("uncovered", F.coalesce("uncovered", F.array().cast("array<string>")))
    strict = (F.col("build_mode") == "production") & ~F.col("clean_plate") & ~F.col("holes")
    return rows.select("scene_id", F.when(strict, F.col("uncovered")).otherwise(F.array().cast("array<string>")).alias("uncovered"), (~strict | (F.size("uncovered") == 0)).alias("passed"))


def depth_gate(scenes: DataFrame, most: float) -> DataFrame:
    """scenes (build_mode, modality, median_error or null) with required and passed: needed in production for depth sensors."""
    required = (F.col("build_mode") == "production") & F.col("modality").isin("rgbd", "lidar")
    passed = F.when(F.col("median_error").isNull(), ~required).otherwise(F.col("median_error") <= most)
    return scenes.withColumns({"required": required, "passed": passed})


def heldout_check(evaluated: Column, expected: Column) -> Column:
    return (expected > 0) & (evaluated == expected)


def approve_segmentation(objects: DataFrame, masks: DataFrame, min_views: int, least_coverage: float) -> DataFrame:
    """(scene_id, failures): why a scene's segmentation can't be approved, in order of the objects; empty if it can.

    Objects without masks aren't reviewed, rejected ones don't count. A scene with no reviewable object fails as such.
    """
    counted = objects.join(masks.select("scene_id", "instance_id", "masks"), ["scene_id", "instance_id"], "left")
    reviewable = F.coalesce("masks", F.lit(0)) > 0
    considered = reviewable & (F.col("state") != "rejected")
    failures = F.array_compact(F.array(
        F.when(considered & (F.col("state") != "approved"), F.concat("instance_id", F.lit(": state="), "state")),
        F.when(considered & (F.col("masks") < min_views), F.format_string(f"%s: %d masks (< {min_views})", "instance_id", "masks")),
        F.when(considered & F.col("movable") & (F.col("coverage") < least_coverage), F.concat("instance_id", F.lit(": background"))),
    ))
    by_scene = counted.groupBy("scene_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("instance_id", failures.alias("f")))), lambda x: x["f"])).alias("_f"), F.bool_or(reviewable).alias("_any"))
    return by_scene.select("scene_id", F.when(F.col("_any"), F.col("_f")).otherwise(F.array(F.lit("no masked object"))).alias("failures"))


def missing_physics(physics: Column) -> Column:
    return F.array_except(F.array(*[F.lit(k) for k in PHYSICS_KEYS]), F.map_keys(physics))


def apply_reviews(objects: DataFrame, decisions: DataFrame) -> DataFrame:
    """objects with what decisions (scene_id, instance_id and any of the other columns, null for no change) say."""
    changed = [c for c in decisions.columns if c not in ("scene_id", "instance_id")]
    said = decisions.select("scene_id", "instance_id", *[F.col(c).alias(f"_{c}") for c in changed])
    return objects.join(said, ["scene_id", "instance_id"], "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in changed else F.col(c) for c in objects.columns])


def scene_config_checks(scenes: DataFrame) -> DataFrame:
    """(scene_id, problems): settings out of their range, in a fixed order."""
    ok = {
        "modality": F.col("modality").isin("rgb", "rgbd", "lidar"),
        "held_out_ratio": (F.col("held_out_ratio") >= 0) & (F.col("held_out_ratio") < 1),
        "min_views_per_object": F.col("min_views_per_object") >= 1,
        "voxel_size_m": F.col("voxel_size_m") > 0,
        "simplify_ratio": (F.col("simplify_ratio") > 0) & (F.col("simplify_ratio") <= 1),
        "up_axis": F.col("up_axis").isin("Y", "Z"),
        "meters_per_unit": F.col("meters_per_unit") > 0,
    }
    return scenes.select("scene_id", F.array_compact(F.array(*[F.when(~F.coalesce(test, F.lit(False)), name) for name, test in ok.items()])).alias("problems"))


def pipeline_progress(*evidence: DataFrame) -> DataFrame:
    """(scene_id, stages): the stages that any of the evidence tables (scene_id, stage) shows as done, sorted."""
    rows = evidence[0].select("scene_id", "stage")
    for more in evidence[1:]:
        rows = rows.unionByName(more.select("scene_id", "stage"))
    return rows.groupBy("scene_id").agg(F.array_sort(F.collect_set("stage")).alias("stages"))


def dense_core(points: DataFrame, key: list[str]) -> DataFrame:
    """The points within the middle half of each axis where a key has 32 or more and at least 16 stay; else within percentiles 10 to 90
    if at least 8 stay; else all."""
    spans = quantiles(points, key, {c: [0.1, 0.25, 0.75, 0.9] for c in "xyz"}).select(*key, F.col("n").alias("_n"), *[F.col(c).alias(f"_{c}") for c in "xyz"])
    inside = lambda lo, hi: (F.col("x").between(F.element_at("_x", lo), F.element_at("_x", hi))) & (F.col("y").between(F.element_at("_y", lo), F.element_at("_y", hi))) & (F.col("z").between(F.element_at("_z", lo), F.element_at("_z", hi)))
    marked = points.join(spans, key).withColumns({"_half": inside(2, 3), "_wide": inside(1, 4)})
    counts = marked.groupBy(*key).agg(F.count_if("_half").alias("_halves"), F.count_if("_wide").alias("_wides"))
    big = F.col("_n") >= 32
    keep = F.when(big & (F.col("_halves") >= 16), F.col("_half")).when(big & (F.col("_wides") >= 8), F.col("_wide")).otherwise(True)
    return marked.join(counts, key).where(keep).select(points.columns)
