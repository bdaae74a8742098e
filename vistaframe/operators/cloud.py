"""Cleaning of Gaussian clouds, with a count for each rule; bounds and statistics of a scene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaframe.operators.quantiles import quantiles
from vistaframe.operators.spatial import neighbor_counts
from vistaframe.sources.tables import written

#: Points from which the observed bounds of a scene are taken.
LEAST_POINTS = 32
RULES = ("opacity", "scale", "needle", "crop", "density", "views", "outlier")


def observed_bounds(points: DataFrame, pct: float = 2.0) -> DataFrame:
    """(scene_id, lo_x, lo_y, lo_z, hi_x, ...): percentiles pct and 100 - pct of each axis, null with fewer than LEAST_POINTS points."""
    spans = quantiles(points, ["scene_id"], {c: [pct / 100, 1 - pct / 100] for c in "xyz"})
    return spans.select("scene_id", *[F.when(F.col("n") >= LEAST_POINTS, F.element_at(c, k)).alias(f"{n}_{c}") for k, n in ((1, "lo"), (2, "hi")) for c in "xyz"])


def scene_stats(gaussians: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Bounds of each scene (the observed ones, else its own percentiles 2 and 98), spans of 1e-9 or more, and the diagonal."""
    own = quantiles(gaussians, ["scene_id"], {c: [0.02, 0.98] for c in "xyz"})
    own = own.select("scene_id", *[F.element_at(c, k).alias(f"own_{n}_{c}") for k, n in ((1, "lo"), (2, "hi")) for c in "xyz"])
    if bounds is not None:
        own = own.join(bounds, "scene_id", "left")
    pick = lambda n, c: F.coalesce(F.col(f"{n}_{c}"), F.col(f"own_{n}_{c}")) if bounds is not None else F.col(f"own_{n}_{c}")
    both = own.select("scene_id", *[pick(n, c).alias(f"{n}_{c}") for n in ("lo", "hi") for c in "xyz"])
    spans = both.withColumns({f"span_{c}": F.greatest(F.col(f"hi_{c}") - F.col(f"lo_{c}"), F.lit(1e-9)) for c in "xyz"})
    return spans.withColumn("diagonal", F.sqrt(sum(F.col(f"span_{c}") * F.col(f"span_{c}") for c in "xyz")))


def extent(points: DataFrame) -> DataFrame:
    """Smallest and largest coordinates of each scene."""
    return points.groupBy("scene_id").agg(*[f(c).alias(f"{n}_{c}") for f, n in ((F.min, "min"), (F.max, "max")) for c in "xyz"])


def longest() -> Column:
    return F.greatest("sx", "sy", "sz")


def too_faint(least: float) -> Column:
    return F.col("opacity") < least


def too_large(most: float | None, share: float | None) -> Column:
    limits = ([F.lit(most)] if most is not None else []) + ([F.col("diagonal") * share] if share is not None else [])
    return longest() > (F.least(*limits) if len(limits) > 1 else limits[0]) if limits else F.lit(False)


def too_thin(ratio: float, share: float) -> Column:
    """A needle: much longer than it is wide, and long for its scene."""
    second = F.element_at(F.array_sort(F.array("sx", "sy", "sz")), 2)
    return (longest() / F.greatest(second, F.lit(1e-12)) > ratio) & (longest() > F.col("diagonal") * share)


def outside(margin: float) -> Column:
    inside = F.lit(True)
    for c in "xyz":
        inside = inside & F.col(c).between(F.col(f"lo_{c}") - F.col(f"span_{c}") * margin, F.col(f"hi_{c}") + F.col(f"span_{c}") * margin)
    return ~inside


def radius_limits(survivors: DataFrame, outlier_std: float, least: int = 8) -> DataFrame:
    """(scene_id, mx, my, mz, limit): medians of the survivors and the largest distance from them that stays; no row below `least` survivors.

    The limit is outlier_std times 1.4826 times the median deviation of the distances from their median (or their standard
    deviation where that vanishes), held against the distance itself.
    """
    first = lambda c: F.element_at(c, 1)
    centre = quantiles(survivors, ["scene_id"], {c: [0.5] for c in "xyz"}).where(F.col("n") >= least).select("scene_id", *[first(c).alias(f"m{c}") for c in "xyz"])
    distance = F.sqrt(sum((F.col(c) - F.col(f"m{c}")) * (F.col(c) - F.col(f"m{c}")) for c in "xyz"))
    far = written(survivors.join(centre, "scene_id").select("scene_id", distance.alias("d")))
    middle = quantiles(far, ["scene_id"], {"d": [0.5]}).select("scene_id", first("d").alias("md"))
    off = far.join(middle, "scene_id").select("scene_id", F.abs(F.col("d") - F.col("md")).alias("off"))
    deviation = far.groupBy("scene_id").agg(F.stddev_pop("d").alias("sd"))
    spread = quantiles(off, ["scene_id"], {"off": [0.5]}).select("scene_id", first("off").alias("mad")).join(deviation, "scene_id")
    sigma = F.when(F.col("mad") * 1.4826 < 1e-9, F.col("sd") + 1e-9).otherwise(F.col("mad") * 1.4826)
    return centre.join(spread.select("scene_id", (sigma * outlier_std).alias("limit")), "scene_id")


def mad_radius_filter(survivors: DataFrame, outlier_std: float) -> DataFrame:
    """survivors with far: whether a row lies beyond its scene's limit."""
    limits = radius_limits(survivors, outlier_std)
    distance = F.sqrt(sum((F.col(c) - F.col(f"m{c}")) * (F.col(c) - F.col(f"m{c}")) for c in "xyz"))
    return survivors.join(limits, "scene_id", "left").withColumn("far", F.coalesce(distance > F.col("limit"), F.lit(False))).drop("mx", "my", "mz", "limit")


def row_reasons(rows: DataFrame, min_opacity: float | None, max_scale: float | None, scale_share: float | None, needle_ratio: float | None, needle_share: float, crop_margin: float | None, extra_rules: list[tuple[str, Column]]) -> DataFrame:
    """rows with reason: the first rule of those on a row alone that it fails, or null."""
    tests = [
        ("opacity", too_faint(min_opacity) if min_opacity else None),
        ("scale", too_large(max_scale, scale_share)),
        ("needle", too_thin(needle_ratio, needle_share) if needle_ratio else None),
        ("crop", outside(crop_margin) if crop_margin is not None else None),
        *extra_rules,
    ]
    return rows.withColumn("reason", F.coalesce(*[F.when(test, name) for name, test in tests if test is not None], F.lit(None).cast("string")))


def clean_gaussians(
    gaussians: DataFrame, bounds: DataFrame | None = None, views: DataFrame | None = None, *, min_opacity: float | None = None, max_scale: float | None = None, scale_share: float | None = None, needle_ratio: float | None = None,
    needle_share: float = 0.02, crop_margin: float | None = None, density_radius: float | None = None, density_least: int = 0, min_views: int = 0, outlier_std: float | None = None, extra_rules: list[tuple[str, Column]] | None = None,
) -> DataFrame:
    """gaussians with reason: null for those that stay, else the first rule that removes them, in the order of RULES.

    Rules on a row alone are one expression. Then neighbours are counted among the survivors, then views, then the survivors'
    medians are taken, so each rule counts what the rules before it have left. density_radius is in scene units; views has
    (scene_id, gaussian_id, views). Statistics are one row a scene; the cloud is joined by scene, cell or id. What the rules
    before the last leave is written, as three statistics are taken of it.
    """
    stats = scene_stats(gaussians, bounds)
    rows = gaussians.join(stats, "scene_id")
    rows = row_reasons(rows, min_opacity, max_scale, scale_share, needle_ratio, needle_share, crop_margin, extra_rules or []).select(*gaussians.columns, "reason")
    if density_radius and density_least:
        left = rows.where("reason IS NULL")
        many = left.groupBy("scene_id").agg(F.count(F.lit(1)).alias("_left"))
        near = neighbor_counts(left.select("scene_id", F.col("gaussian_id").alias("id"), "x", "y", "z"), density_radius, density_least).withColumnRenamed("id", "gaussian_id")
        alone = (F.col("_left") > density_least) & (F.col("neighbors") < density_least)
        rows = rows.join(near, ["scene_id", "gaussian_id"], "left").join(many, "scene_id", "left").withColumn("reason", F.coalesce("reason", F.when(alone, "density"))).select(*gaussians.columns, "reason")
    if views is not None and min_views:
        seen = views.select("scene_id", "gaussian_id", "views")
        rows = rows.join(seen, ["scene_id", "gaussian_id"], "left").withColumn("reason", F.coalesce("reason", F.when(F.coalesce("views", F.lit(0)) < min_views, "views"))).select(*gaussians.columns, "reason")
    if outlier_std:
        rows = written(rows)
        limits = radius_limits(rows.where("reason IS NULL"), outlier_std)
        distance = F.sqrt(sum((F.col(c) - F.col(f"m{c}")) * (F.col(c) - F.col(f"m{c}")) for c in "xyz"))
        rows = rows.join(limits, "scene_id", "left").withColumn("reason", F.coalesce("reason", F.when(distance > F.col("limit"), "outlier"))).select(*gaussians.columns, "reason")
    return rows


def cleanup_report(cleaned: DataFrame) -> DataFrame:
    """Counts by scene: what came in, what stays, what each rule removed."""
    return cleaned.groupBy("scene_id").agg(F.count(F.lit(1)).alias("input"), F.count_if(F.col("reason").isNull()).alias("kept"), *[F.count_if(F.coalesce(F.col("reason") == r, F.lit(False))).alias(f"removed_{r}") for r in RULES])


def cleanliness(report: DataFrame) -> DataFrame:
    """What share of the input each rule removed; null for an empty input."""
    whole = F.nullif(F.col("input"), F.lit(0))
    return report.select("scene_id", "kept", *[(F.col(f"removed_{r}") / whole).alias(f"share_{r}") for r in RULES])


def trimmed_aabb(points: DataFrame, key: list[str], pct: float = 5.0, max_extent: float | None = None) -> DataFrame:
    """The box of percentiles pct and 100 - pct of each key; with max_extent no wider than that about its middle."""
    spans = quantiles(points, key, {c: [pct / 100, 1 - pct / 100] for c in "xyz"})
    out = []
    for c in "xyz":
        lo, hi = F.element_at(c, 1), F.element_at(c, 2)
        if max_extent is not None:
            half, middle = F.least((hi - lo) / 2, F.lit(max_extent / 2)), (lo + hi) / 2
            lo, hi = middle - half, middle + half
        out += [lo.alias(f"lo_{c}"), hi.alias(f"hi_{c}")]
    return spans.select(*key, *out)


def visibility_percentile_cut(rows: DataFrame, share: float) -> DataFrame:
    """Rows (scene_id, visibility) strictly above their scene's percentile."""
    cut = quantiles(rows, ["scene_id"], {"visibility": [share]}).select("scene_id", F.element_at("visibility", 1).alias("_cut"))
    return rows.join(cut, "scene_id").where(F.col("visibility") > F.col("_cut")).drop("_cut")


def visibility_distribution(rows: DataFrame) -> DataFrame:
    """Percentiles of visibility in each scene, and how many rows have none."""
    shares = {"p0_1": 0.001, "p1": 0.01, "p5": 0.05, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    zeros = rows.groupBy("scene_id").agg(F.count_if(F.col("visibility") == 0).alias("zeros"))
    found = quantiles(rows, ["scene_id"], {"visibility": list(shares.values())}).withColumnRenamed("visibility", "_p").join(zeros, "scene_id")
    return found.select("scene_id", "zeros", *[F.element_at("_p", k).alias(n) for k, n in enumerate(shares, 1)])
