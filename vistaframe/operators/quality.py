"""Photometric summaries, quality scores, checks and gates, tuning trials, artifact lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaframe.functions.geometry import clip, finite
from vistaframe.operators.quantiles import quantiles


def psnr(pairs: DataFrame, key: list[str]) -> DataFrame:
    """Peak signal-to-noise ratio of the pixels (ref, render) of each key; infinite where they hardly differ."""
    mse = F.avg((F.col("ref") - F.col("render")) * (F.col("ref") - F.col("render")))
    found = pairs.groupBy(*key).agg(mse.alias("mse"))
    return found.select(*key, F.when(F.col("mse") <= 1e-12, F.lit(float("inf"))).otherwise(-10 * F.log10("mse")).alias("psnr"))


def photometric_summary(views: DataFrame, expected: DataFrame | None = None, key: tuple[str, ...] = ("scene_id",)) -> DataFrame:
    """evaluated, mean_psnr over the finite ones, mean_ssim over all, mean_lpips over those that have one; null if there is none.

    expected (key, expected) adds how many views were asked for and how many are missing; keys without views count 0.
    """
    found = views.groupBy(*key).agg(F.count(F.lit(1)).alias("evaluated"), F.avg(F.when(finite(F.col("psnr")), F.col("psnr"))).alias("mean_psnr"), F.avg("ssim").alias("mean_ssim"), F.avg("lpips").alias("mean_lpips"))
    if expected is None:
        return found
    both = expected.join(found, list(key), "left").withColumn("evaluated", F.coalesce("evaluated", F.lit(0)))
    return both.withColumn("missing", F.col("expected") - F.col("evaluated"))


def quality_score(ssim: Column, psnr: Column, lpips: Column, registration_error: Column, threshold: float, failed: Column) -> tuple[Column, Column]:
    """(appearance, total) on 0 to 100, null without both ssim and psnr.

    Shares: 0.45 ssim, 0.35 similarity, 0.20 psnr of 40; without lpips 0.80 and 0.20. A registration error above the
    threshold costs 10, each failed check 5, up to 30. Rounded half to even at three places.
    """
    s = clip(F.coalesce(ssim, F.lit(0.0)), 0.0, 1.0)
    p = clip(F.coalesce(psnr, F.lit(0.0)) / 40, 0.0, 1.0)
    near = clip(1 - lpips, 0.0, 1.0)
    appearance = F.when(lpips.isNotNull(), 100 * (0.45 * s + 0.35 * near + 0.2 * p)).otherwise(100 * (0.8 * s + 0.2 * p))
    appearance = F.when(ssim.isNotNull() | psnr.isNotNull(), appearance)
    off = F.when(F.coalesce(registration_error > threshold, F.lit(False)), 10.0).otherwise(0.0) + F.least(F.lit(30.0), 5.0 * F.coalesce(failed, F.lit(0)))
    total = F.when(appearance.isNotNull(), F.greatest(appearance - off, F.lit(0.0)))
    return F.bround(appearance, 3), F.bround(total, 3)


def validation_report(checks: DataFrame, key: tuple[str, ...] = ("scene_id",)) -> DataFrame:
    """usable: no required check failed; and the names of the failed required and failed optional checks, in order of the checks."""
    failed = lambda required: F.transform(F.array_sort(F.collect_list(F.when(~F.col("passed") & (F.col("required") == required), F.struct("ordinal", "name")))), lambda x: x["name"])
    found = checks.groupBy(*key).agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed") & F.col("required")).alias("failed"), failed(True).alias("failed_required"), failed(False).alias("failed_optional"))
    return found.withColumn("usable", F.col("failed") == 0)


def production_gate(scale: DataFrame, paths: DataFrame, objects: DataFrame, needs_objects: bool = True) -> DataFrame:
    """(scene_id, ready): metric scale approved, a path to the world frame, and an approved object unless none is needed."""
    approved = objects.groupBy("scene_id").agg(F.bool_or(F.col("state") == "approved").alias("has_object"))
    linked = paths.groupBy("scene_id").agg(F.bool_or("reaches").alias("linked"))
    rows = scale.join(linked, "scene_id", "left").join(approved, "scene_id", "left")
    ok = F.coalesce("metric", F.lit(False)) & F.coalesce("linked", F.lit(False))
    return rows.select("scene_id", (ok & F.coalesce("has_object", F.lit(False)) if needs_objects else ok).alias("ready"))


def best_trial(trials: DataFrame, key: tuple[str, ...] = ()) -> DataFrame:
    """Of the scored trials with a score the best; of equal ones the first inserted."""
    scored = trials.where((F.col("status") == "scored") & F.col("quality_score").isNotNull())
    best = F.max_by(F.struct(*trials.columns), F.struct("quality_score", -F.col("ordinal")))
    return scored.groupBy(*key).agg(best.alias("_best")).where("_best IS NOT NULL").select("_best.*")


def trial_budget(trials: DataFrame, pending: DataFrame, budget: int) -> DataFrame:
    """The pending trials of each kind that still fit when scored ones count against the budget, in order."""
    done = trials.where("status = 'scored'").groupBy("kind").agg(F.count(F.lit(1)).alias("_done"))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("ordinal"))
    rows = pending.withColumn("_rank", rank).join(F.broadcast(done), "kind", "left")
    return rows.where(F.col("_rank") <= budget - F.coalesce("_done", F.lit(0))).select(pending.columns)


def param_grid(spark, spaces: dict[str, list[float]]) -> DataFrame:
    """Every combination of the listed values, keys in order, with its ordinal: a bounded table made of literals."""
    grid = spark.range(1).select(F.lit(0).cast("long").alias("ordinal"))
    for name in sorted(spaces):
        values = F.posexplode(F.array(*[F.lit(v) for v in spaces[name]])).alias("_at", name)
        grid = grid.select("*", values).withColumn("ordinal", F.col("ordinal") * len(spaces[name]) + F.col("_at")).drop("_at")
    return grid


def pending_params(grid: DataFrame, trials: DataFrame, kind: str, names: list[str]) -> DataFrame:
    """Combinations of the grid that no scored trial of the kind has had."""
    had = trials.where((F.col("status") == "scored") & (F.col("kind") == kind)).select(*names)
    return grid.join(had, names, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: str, keeps_place: bool = True) -> DataFrame:
    """Rows of old replaced or joined by those of new with the same key. order is the place of a row; a replaced one keeps its
    place, or takes the new one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    latest = F.max_by(F.struct(*old.columns), F.struct("_new", order)).alias("_row")
    merged = both.groupBy(*key).agg(latest, F.min(F.struct("_new", order)).alias("_first"))
    place = F.col(f"_first.{order}") if keeps_place else F.col(f"_row.{order}")
    return merged.select(*[(place if c == order else F.col(f"_row.{c}")).alias(c) for c in old.columns])


def stale_artifacts(artifacts: DataFrame, hashes: DataFrame) -> DataFrame:
    """artifacts with stale: missing, or stamped with another hash than the scene's (transform_hash of hashes); never by hash where a scene has none."""
    current = hashes.select("scene_id", F.col("transform_hash").alias("_now"))
    other = F.col("_now").isNotNull() & ~F.col("transform_hash").eqNullSafe(F.col("_now"))
    return artifacts.join(current, "scene_id", "left").withColumn("stale", ~F.col("file_exists") | other).drop("_now")


def missing_views(held_out: DataFrame, references: DataFrame, renders: DataFrame, key: list[str]) -> DataFrame:
    """Held-out views that lack a reference or a render."""
    return held_out.join(references.select(*key).join(renders.select(*key), key).distinct(), key, "left_anti")


def experiment_compare(metrics: DataFrame, names: list[str]) -> DataFrame:
    """(scene_id, A, B, C, c_beats_a) from rows (scene_id, arm, metrics map): the first of the named metrics that is a number."""
    value = F.coalesce(*[F.try_element_at("metrics", F.lit(n)).try_cast("double") for n in names])
    arms = metrics.select("scene_id", "arm", value.alias("_v")).groupBy("scene_id").pivot("arm", ["A", "B", "C"]).agg(F.max("_v"))
    return arms.withColumn("c_beats_a", F.coalesce(F.col("C") > F.col("A"), F.lit(False)))


def registration_error(errors: DataFrame, threshold: float) -> DataFrame:
    """Median and 95th percentile of distance for each scene, and whether the median stays within the threshold."""
    found = quantiles(errors, ["scene_id"], {"distance": [0.5, 0.95]}).select("scene_id", F.element_at("distance", 1).alias("median"), F.element_at("distance", 2).alias("p95"))
    return found.withColumn("passed", F.col("median") <= threshold)


def scene_registration(points: DataFrame, vertices: DataFrame, threshold: float, most_points: int = 5_000, most_vertices: int = 200_000, cell: float = 0.5) -> DataFrame:
    """registration_error() of the distances from each scene's points to its nearest mesh vertex; of more points or vertices than given an
    even sample in order of id, as the measure asks. points, vertices: scene_id, id, x, y, z."""
    from vistaframe.operators.spatial import linspace_sample, nearest_join

    return registration_error(nearest_join(linspace_sample(points, "scene_id", ["id"], most_points), linspace_sample(vertices, "scene_id", ["id"], most_vertices), cell), threshold)


def lighting_estimate(pixels: DataFrame) -> DataFrame:
    """Exposure and white balance of each scene from pixels (scene_id, r, g, b from 0 to 1) that aren't saturated."""
    lit = [F.pow(F.col(c), 2.2) for c in "rgb"]
    unsaturated = pixels.where((F.least("r", "g", "b") > 0.02) & (F.greatest("r", "g", "b") < 0.98))
    mean = unsaturated.groupBy("scene_id").agg(*[F.avg(x).alias(c) for x, c in zip(lit, "rgb", strict=True)])
    gray = (F.col("r") + F.col("g") + F.col("b")) / 3
    luminance = 0.2126 * F.col("r") + 0.7152 * F.col("g") + 0.0722 * F.col("b")
    balance = [clip(gray / F.greatest(F.col(c), F.lit(1e-5)), 0.5, 2.0).alias(f"balance_{c}") for c in "rgb"]
    return mean.select("scene_id", F.log2(0.18 / F.greatest(luminance, F.lit(1e-6))).alias("exposure"), *balance)
