"""Reports over scenes and objects: quality of a build, checks of objects, what was lifted, and approvals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaframe.operators import quality as Q

#: What an object's physics must name before its asset can be approved.
ASSET_PHYSICS = ("mass_kg", "diagonal_inertia_kg_m2", "friction", "restitution")
ASSET_FILES = ("render_mesh", "collision_mesh", "baked_texture")


def scene_quality_report(scenes: DataFrame, photometric: DataFrame, cleanup: DataFrame, builds: DataFrame, threshold: float) -> DataFrame:
    """One row for each of scenes (scene_id): scores, photometric means and counts, cleanliness, registration and validation.

    photometric: scene_id, evaluated, expected, mean_psnr, mean_ssim, mean_lpips; cleanup: cloud.cleanup_report(); builds:
    scene_id, usable, failed (how many required checks), registration_median. A scene that lacks one of them has nulls there, and
    no failed checks; shares are null where nothing was cleaned.
    """
    rows = scenes.select("scene_id").join(photometric.select("scene_id", "evaluated", "expected", "mean_psnr", "mean_ssim", "mean_lpips"), "scene_id", "left")
    clean = cleanup.where("input > 0").select("scene_id", F.col("kept").alias("gaussian_count"), *[(F.col(f"removed_{r}") / F.col("input")).alias(f"removed_{r}_fraction") for r in ("opacity", "outlier")])
    rows = rows.join(clean, "scene_id", "left").join(builds.select("scene_id", "usable", "failed", "registration_median"), "scene_id", "left")
    failed = F.coalesce("failed", F.lit(0))
    appearance, total = Q.quality_score(F.col("mean_ssim"), F.col("mean_psnr"), F.col("mean_lpips"), F.col("registration_median"), threshold, failed)
    scored = appearance.isNotNull()
    far = F.when(scored & F.coalesce(F.col("registration_median") > threshold, F.lit(False)), 10.0).otherwise(0.0)
    checks = F.when(scored, F.least(F.lit(30.0), 5.0 * failed)).otherwise(0.0)
    return rows.select(
        "scene_id", total.alias("quality_score"), appearance.alias("appearance_score"), far.alias("registration_penalty"), checks.alias("failed_check_penalty"), "mean_psnr", "mean_ssim", "mean_lpips",
        F.coalesce("evaluated", F.lit(0)).alias("evaluated_views"), F.coalesce("expected", F.lit(0)).alias("expected_views"), "gaussian_count", "removed_opacity_fraction", "removed_outlier_fraction",
        "registration_median", F.lit(threshold).alias("registration_threshold"), "usable", failed.alias("failed_required"),
    )


def trial_metrics(trials: DataFrame, reports: DataFrame) -> DataFrame:
    """trials with the score and five metrics of their report (scene_quality_report() rows with trial_id); nulls without one."""
    own = ["quality_score", "mean_psnr", "mean_ssim", "mean_lpips", "evaluated_views", "gaussian_count"]
    rest = [c for c in trials.columns if c not in own]
    return trials.select(rest).join(reports.select("trial_id", *own), "trial_id", "left").select(*rest, *own)


def movable_approved(objects: DataFrame) -> DataFrame:
    return objects.where(F.col("movable") & (F.col("review_state") == "approved"))


def missing_keys(physics: Column) -> Column:
    """The keys of ASSET_PHYSICS that a map lacks, sorted."""
    return F.array_sort(F.array_except(F.array(*[F.lit(k) for k in ASSET_PHYSICS]), F.coalesce(F.map_keys(physics), F.array().cast("array<string>"))))


def object_checks(scenes: DataFrame, objects: DataFrame, most_faces: int, least_coverage: float) -> DataFrame:
    """(scene_id, instance_id, name, passed, required, missing): the checks of each movable approved object; required in production.

    scenes: scene_id, build_mode, clean_plate. objects: files (map from a file's role to whether it exists), watertight, vertices, uvs and
    collider_faces (null where the mesh is missing, which has no check), physics (map), physics_approved, coverage.
    files: all exist; visual_mesh: closed, with as many texture coordinates as vertices; collider: faces within the limit;
    physics: all keys, and approved in production; background: seen well enough, or a clean plate.
    """
    rows = movable_approved(objects).join(scenes.select("scene_id", (F.col("build_mode") == "production").alias("required"), "clean_plate"), "scene_id")
    absent = F.array_sort(F.map_keys(F.map_filter("files", lambda _, there: ~F.coalesce(there, F.lit(False)))))
    lacking = missing_keys(F.col("physics"))
    none = F.array().cast("array<string>")
    checks = {
        "object_files": (F.lit(True), F.size(absent) == 0, absent),
        "object_visual_mesh": (F.col("vertices").isNotNull(), F.col("watertight") & (F.coalesce("uvs", F.lit(-1)) == F.col("vertices")), none),
        "object_collider": (F.col("collider_faces").isNotNull(), F.col("collider_faces") <= most_faces, none),
        "object_physics": (F.lit(True), (F.size(lacking) == 0) & (~F.col("required") | F.coalesce("physics_approved", F.lit(False))), lacking),
        "object_background": (F.lit(True), (F.coalesce("coverage", F.lit(0.0)) >= least_coverage) | F.col("clean_plate"), none),
    }
    each = F.array(*[F.when(there, F.struct(F.lit(name).alias("name"), F.coalesce(passed, F.lit(False)).alias("passed"), missing.alias("missing"))) for name, (there, passed, missing) in checks.items()])
    return rows.select("scene_id", "instance_id", "required", F.explode(F.array_compact(each)).alias("c")).select("scene_id", "instance_id", "c.name", "c.passed", "required", "c.missing")


def lift_summary(lifted: DataFrame, many: int = 400) -> DataFrame:
    """detections, frames, how many were lifted (points is not null), the median overlap of those, and how many have more than `many` points,
    for each scene. lifted: lift.lift_debug()."""
    found = F.col("points").isNotNull()
    return lifted.groupBy("scene_id").agg(
        F.count(F.lit(1)).alias("detections"), F.count_distinct("image_id").alias("frames"), F.count_if(found).alias("lifted"), F.median(F.when(found, F.col("iou"))).alias("median_iou"), F.count_if(found & (F.col("points") > many)).alias("many_points")
    )


def masks_ready(scenes: DataFrame, artifacts: DataFrame, masks: DataFrame, name: str = "instance_masks") -> DataFrame:
    """The scenes whose mask report exists and that have a mask at all."""
    report = artifacts.where((F.col("artifact_id") == name) & F.col("file_exists")).select("scene_id")
    return scenes.join(report, "scene_id", "left_semi").join(masks.select("scene_id"), "scene_id", "left_semi")


def approve_asset(objects: DataFrame, reviewer: str) -> DataFrame:
    """(scene_id, instance_id, failures, gate, state, reviewer): what keeps an object's asset from approval, or else its approval.

    objects: files (map from a role of ASSET_FILES to whether it exists) and physics (map).
    """
    no_file = F.filter(F.array(*[F.lit(f) for f in ASSET_FILES]), lambda f: ~F.coalesce(F.try_element_at("files", f), F.lit(False)))
    failures = F.concat(F.transform(no_file, lambda f: F.concat(F.lit("no file: "), f)), F.transform(missing_keys(F.col("physics")), lambda k: F.concat(F.lit("no physics: "), k)))
    rows = objects.withColumn("failures", failures)
    ok = F.size("failures") == 0
    return rows.select("scene_id", "instance_id", "failures", *[F.when(ok, x).alias(n) for x, n in ((F.concat(F.lit("asset:"), F.col("instance_id")), "gate"), (F.lit("approved"), "state"), (F.lit(reviewer), "reviewer"))])


def approve_lighting(artifacts: DataFrame, scenes: DataFrame, reviewer: str, name: str = "scene_lighting") -> DataFrame:
    """(scene_id, gate, state, reviewer) of the scenes that have a lighting artifact; a scene without one has a null state."""
    have = artifacts.where(F.col("artifact_id") == name).select("scene_id", F.lit(True).alias("_has")).distinct()
    rows = scenes.select("scene_id").join(have, "scene_id", "left")
    return rows.select("scene_id", F.lit("lighting").alias("gate"), F.when(F.col("_has"), "approved").alias("state"), F.when(F.col("_has"), reviewer).alias("reviewer"))


def latest_run(runs: DataFrame, key: list[str], explicit: DataFrame | None = None) -> DataFrame:
    """(key, path): the newest run (key, path, modified) of each key, of equally new ones the last path; a path of explicit (key, path)
    comes before any."""
    newest = runs.groupBy(*key).agg(F.max_by("path", F.struct("modified", "path")).alias("path"))
    if explicit is None:
        return newest
    return explicit.select(*key, "path").unionByName(newest.join(explicit, key, "left_anti"))
