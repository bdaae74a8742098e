"""Queries over view metrics, checks, trials and artifacts, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaframe.operators import quality as Q
from vistaframe.plans.helpers import Registry, rounded
from vistaframe.sources.fixtures import view

R = Registry()


@R.query("WITH m AS (SELECT image_id, avg((ref-render)*(ref-render)) AS mse FROM pixel_pairs GROUP BY 1) SELECT image_id, round(CASE WHEN mse <= 1e-12 THEN CAST('Infinity' AS DOUBLE) ELSE 10*log10(1/mse) END, 6) AS psnr FROM m", "pixel_pairs")
def psnr(spark, d):
    return rounded(Q.psnr(view(spark, d, "pixel_pairs"), ["image_id"]))


SUMMARY = "s AS (SELECT scene_id, trial, count(*) AS evaluated, avg(CASE WHEN isfinite(psnr) THEN psnr END) AS mean_psnr, avg(ssim) AS mean_ssim, avg(lpips) AS mean_lpips FROM view_metrics GROUP BY ALL)"


def _summary(spark, d):
    return Q.photometric_summary(view(spark, d, "view_metrics"), key=("scene_id", "trial"))


@R.query(f"WITH {SUMMARY} SELECT scene_id, trial, evaluated, round(mean_psnr, 6) AS mean_psnr, round(mean_ssim, 6) AS mean_ssim, round(mean_lpips, 6) AS mean_lpips FROM s", "view_metrics")
def photometric_summary(spark, d):
    return rounded(_summary(spark, d))


@R.query(f"WITH {SUMMARY}, f AS (SELECT scene_id, count(*) FILTER (NOT passed AND required) % 8 AS failed FROM checks GROUP BY 1), a AS (SELECT s.*, f.failed, 100*(0.45*least(greatest(mean_ssim,0),1)+0.35*least(greatest(1-mean_lpips,0),1)+0.2*least(greatest(mean_psnr/40,0),1)) AS app FROM s JOIN f USING (scene_id)) SELECT scene_id, trial, round_even(round_even(app, 3), 1) AS appearance, round_even(round_even(greatest(0, app - least(30, 5*failed) - CASE WHEN trial > 5 THEN 10 ELSE 0 END), 3), 1) AS total FROM a", "view_metrics", "checks")
def quality_score(spark, d):
    failed = Q.validation_report(view(spark, d, "checks")).select("scene_id", (F.col("failed") % 8).alias("failed"))
    rows = _summary(spark, d).join(failed, "scene_id")
    appearance, total = Q.quality_score(F.col("mean_ssim"), F.col("mean_psnr"), F.col("mean_lpips"), F.col("trial") * 1.0, 5.0, F.col("failed"))
    return rows.select("scene_id", "trial", F.bround(appearance, 1).alias("appearance"), F.bround(total, 1).alias("total"))


@R.query("SELECT scene_id, count(*) AS checks, count(*) FILTER (NOT passed AND required) AS failed, array_to_string(list(name ORDER BY ordinal) FILTER (NOT passed AND required), ',') AS names, count(*) FILTER (NOT passed AND required) = 0 AS usable FROM checks GROUP BY 1", "checks")
def validation_report(spark, d):
    return Q.validation_report(view(spark, d, "checks")).select("scene_id", "checks", "failed", F.array_join("failed_required", ",").alias("names"), "usable")


@R.query("SELECT kind, arg_max(ordinal, (quality_score, -ordinal)) AS ordinal, max(quality_score) AS quality_score FROM trials WHERE status = 'scored' AND quality_score IS NOT NULL GROUP BY 1", "trials")
def best_trial(spark, d):
    return Q.best_trial(view(spark, d, "trials"), ("kind",)).select("kind", "ordinal", "quality_score")


@R.query("WITH n AS (SELECT kind, count(*) AS done FROM trials WHERE status = 'scored' GROUP BY 1), p AS (SELECT kind, ordinal, row_number() OVER (PARTITION BY kind ORDER BY ordinal) AS rk FROM trials WHERE status = 'failed') SELECT kind, ordinal FROM p JOIN n USING (kind) WHERE rk <= 1500 - done", "trials")
def trial_budget(spark, d):
    trials = view(spark, d, "trials")
    return Q.trial_budget(trials, trials.where("status = 'failed'"), 1500).select("kind", "ordinal")


GRID = "g AS (SELECT m.i * 4 + o.i AS ordinal, m.v AS min_opacity, o.v AS outlier_std FROM (VALUES (0, 0.01e0), (1, 0.02e0), (2, 0.09e0)) m(i, v) CROSS JOIN (VALUES (0, 1e0), (1, 3e0), (2, 6e0), (3, 8e0)) o(i, v))"


def _grid(spark):
    return Q.param_grid(spark, {"outlier_std": [1.0, 3.0, 6.0, 8.0], "min_opacity": [0.01, 0.02, 0.09]})


@R.query(f"WITH {GRID} SELECT g.ordinal, g.min_opacity, g.outlier_std, count(t.ordinal) AS runs FROM g LEFT JOIN trials t ON t.min_opacity = g.min_opacity AND t.outlier_std = g.outlier_std GROUP BY ALL", "trials")
def param_grid(spark, d):
    """The grid, with how many trials each combination has had."""
    runs = view(spark, d, "trials").groupBy("min_opacity", "outlier_std").agg(F.count(F.lit(1)).alias("runs"))
    return _grid(spark).join(runs, ["min_opacity", "outlier_std"], "left").select("ordinal", "min_opacity", "outlier_std", F.coalesce("runs", F.lit(0)).alias("runs"))


@R.query(f"WITH {GRID} SELECT ordinal, min_opacity, outlier_std FROM g WHERE NOT EXISTS (SELECT 1 FROM trials t WHERE t.status = 'scored' AND t.kind = 'cheap' AND t.min_opacity = g.min_opacity AND t.outlier_std = g.outlier_std)", "trials")
def pending_params(spark, d):
    return Q.pending_params(_grid(spark), view(spark, d, "trials"), "cheap", ["min_opacity", "outlier_std"]).select("ordinal", "min_opacity", "outlier_std")


@R.query("SELECT min(ordinal) AS ordinal, kind, outlier_std, arg_max(quality_score, ordinal) FILTER (quality_score IS NOT NULL) AS quality_score FROM trials WHERE quality_score IS NOT NULL GROUP BY kind, outlier_std", "trials")
def upsert_trials(spark, d):
    """Later trials replace earlier ones of the same parameters and keep their place."""
    trials = view(spark, d, "trials").where("quality_score IS NOT NULL").select("ordinal", "kind", "outlier_std", "quality_score")
    half = (trials.agg(F.max("ordinal")).first()[0] or 0) // 2
    return Q.upsert(trials.where(F.col("ordinal") <= half), trials.where(F.col("ordinal") > half), ["kind", "outlier_std"], "ordinal")


@R.query("WITH h AS (SELECT scene_id, max(transform_hash) AS now FROM artifacts WHERE scene_id <> 's3' GROUP BY 1) SELECT scene_id, artifact_id, NOT file_exists OR (now IS NOT NULL AND transform_hash IS DISTINCT FROM now) AS stale FROM artifacts LEFT JOIN h USING (scene_id)", "artifacts")
def stale_artifacts(spark, d):
    rows = view(spark, d, "artifacts")
    now = rows.where("scene_id <> 's3'").groupBy("scene_id").agg(F.max("transform_hash").alias("transform_hash"))
    return Q.stale_artifacts(rows, now).select("scene_id", "artifact_id", "stale")


@R.query("SELECT scene_id, view_id FROM view_metrics v WHERE NOT (isfinite(psnr) AND lpips IS NOT NULL)", "view_metrics")
def missing_views(spark, d):
    """Views without a finite psnr (a reference) or without lpips (a render)."""
    v = view(spark, d, "view_metrics")
    return Q.missing_views(v.select("scene_id", "view_id"), v.where(F.col("psnr") < float("inf")), v.where("lpips IS NOT NULL"), ["scene_id", "view_id"])


@R.query("WITH a AS (SELECT scene_id, CASE trial WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS arm, max(ssim) AS v FROM view_metrics WHERE trial < 3 AND NOT (trial = 0 AND scene_id = 's2') GROUP BY ALL), p AS (SELECT scene_id, max(v) FILTER (arm = 'A') AS \"A\", max(v) FILTER (arm = 'B') AS \"B\", max(v) FILTER (arm = 'C') AS \"C\" FROM a GROUP BY 1) SELECT scene_id, \"A\" AS a, \"B\" AS b, \"C\" AS c, coalesce(\"C\" > \"A\", false) AS c_beats_a FROM p", "view_metrics")
def experiment_compare(spark, d):
    v = view(spark, d, "view_metrics").where("trial < 3 AND NOT (trial = 0 AND scene_id = 's2')")
    arm = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("trial") + 1).cast("int"))
    best = v.groupBy("scene_id", arm.alias("arm")).agg(F.max("ssim").alias("s"))
    metrics = best.withColumn("metrics", F.create_map(F.lit("other"), F.lit("none"), F.lit("ssim"), F.col("s").cast("string")))
    found = Q.experiment_compare(metrics, ["other", "psnr", "ssim"])
    return found.select("scene_id", F.col("A").alias("a"), F.col("B").alias("b"), F.col("C").alias("c"), "c_beats_a")


@R.query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY point_id) - 1 AS pos, count(*) OVER (PARTITION BY scene_id) AS n FROM points), a AS (SELECT * FROM r WHERE n <= 100 OR pos IN (SELECT CAST(trunc(k * ((n - 1) / 99e0)) AS BIGINT) FROM range(100) t(k))), b AS (SELECT * FROM points WHERE point_id % 3 = 0), d AS (SELECT a.scene_id, a.point_id, sqrt(min((a.x-b.x)**2 + (a.y-b.y)**2 + (a.z-b.z)**2)) AS distance FROM a JOIN b USING (scene_id) GROUP BY ALL) SELECT scene_id, round(median(distance), 4) AS median, round(quantile_cont(distance, 0.95), 4) AS p95, median(distance) <= 0.9 AS passed FROM d GROUP BY 1", "points")
def registration_error(spark, d):
    """A hundred points of each scene against a third of its points."""
    points = view(spark, d, "points").select("scene_id", F.col("point_id").alias("id"), "x", "y", "z")
    return rounded(Q.scene_registration(points, points.where("id % 3 = 0"), 0.9, most_points=100), 4)


@R.query("WITH p AS (SELECT scene_id, r/255e0 AS r, g/255e0 AS g, b/255e0 AS b FROM points), u AS (SELECT scene_id, avg(power(r,2.2)) AS r, avg(power(g,2.2)) AS g, avg(power(b,2.2)) AS b FROM p WHERE least(r,g,b) > 0.02 AND greatest(r,g,b) < 0.98 GROUP BY 1) SELECT scene_id, round(log2(0.18/greatest(0.2126*r+0.7152*g+0.0722*b, 1e-6)), 6) AS exposure, round(least(greatest((r+g+b)/3/greatest(r,1e-5),0.5),2), 6) AS balance_r, round(least(greatest((r+g+b)/3/greatest(g,1e-5),0.5),2), 6) AS balance_g, round(least(greatest((r+g+b)/3/greatest(b,1e-5),0.5),2), 6) AS balance_b FROM u", "points")
def lighting_estimate(spark, d):
    p = view(spark, d, "points")
    return rounded(Q.lighting_estimate(p.select("scene_id", *[(F.col(c) / 255.0).alias(c) for c in "rgb"])))
