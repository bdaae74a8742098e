"""Instance masks as pixel rows: reports, votes, merges and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaframe.operators.cameras import with_cells, with_times
from vistaframe.operators.held import BLOCK, vote_sums

PIXEL = ("scene_id", "instance_id", "frame", "u", "v")


def mask_report(pixels: DataFrame, frame_pixels: int, min_views: int = 3) -> DataFrame:
    """Frames with a mask, the share of their pixels that is masked, and whether they are enough, for each instance."""
    found = pixels.groupBy("scene_id", "instance_id").agg(F.count_distinct("frame").alias("frames"), F.count(F.lit(1)).alias("pixels"))
    return found.select("scene_id", "instance_id", "frames", (F.col("pixels") / F.greatest(F.col("frames") * frame_pixels, F.lit(1))).alias("foreground"), (F.col("frames") >= min_views).alias("meets_min_views"))


def min_area_masks(pixels: DataFrame, least: int = 64) -> DataFrame:
    """(scene_id, instance_id, frame, area) of masks with at least so many pixels."""
    return pixels.groupBy("scene_id", "instance_id", "frame").agg(F.count(F.lit(1)).alias("area")).where(F.col("area") >= least)


def masked_pixel_fraction(pixels: DataFrame, frame_pixels: int) -> DataFrame:
    """The share of a frame's pixels that any instance covers."""
    distinct = pixels.select("scene_id", "frame", "u", "v").distinct()
    return distinct.groupBy("scene_id", "frame").agg((F.count(F.lit(1)) / frame_pixels).alias("fraction"))


def merge_instances(pixels: DataFrame, primary: str, sources: list[str]) -> DataFrame:
    """The union of the masks of primary and sources, under primary, with the instance each pixel comes from first.

    origin keeps provenance: primary where it had the pixel, else the smallest source, so unmerge_instances() can take a
    source out again.
    """
    chosen = pixels.where(F.col("instance_id").isin(primary, *sources))
    origin = F.when(F.max(F.col("instance_id") == primary), F.lit(primary)).otherwise(F.min("instance_id"))
    return chosen.groupBy("scene_id", "frame", "u", "v").agg(origin.alias("origin"), F.array_sort(F.collect_set("instance_id")).alias("owners")).withColumn("instance_id", F.lit(primary))


def unmerge_instances(merged: DataFrame, sources: list[str]) -> DataFrame:
    """merged without the pixels that only the given sources had."""
    left = F.array_except("owners", F.array(*[F.lit(s) for s in sources]))
    return merged.withColumn("owners", left).where(F.size("owners") > 0)


def merge_counts(pixels: DataFrame, primary: str, sources: list[str]) -> DataFrame:
    """For each frame: pixels of primary, pixels that the sources add, pixels that both have."""
    side = pixels.where(F.col("instance_id").isin(primary, *sources)).groupBy("scene_id", "frame", "u", "v").agg(F.max(F.col("instance_id") == primary).alias("own"), F.max(F.col("instance_id") != primary).alias("other"))
    return side.groupBy("scene_id", "frame").agg(F.count_if("own").alias("primary"), F.count_if(~F.col("own")).alias("added"), F.count_if(F.col("own") & F.col("other")).alias("identical"))


def delete_masks(pixels: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pixels without the named (scene_id, instance_id, frame) masks, names that no mask has)."""
    key = ["scene_id", "instance_id", "frame"]
    return pixels.join(names.select(key).distinct(), key, "left_anti"), names.join(pixels.select(key).distinct(), key, "left_anti")


def rename_instances(rows: DataFrame, names: DataFrame, columns: tuple[str, ...] = ("instance_id",)) -> DataFrame:
    """rows with the ids of the given columns renamed by names (scene_id, old, new), of bounded size a scene; others stay."""
    for c in columns:
        rows = rows.join(names.select("scene_id", F.col("old").alias(c), F.col("new").alias("_new")), ["scene_id", c], "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    return rows


def frame_grid(frames: DataFrame) -> DataFrame:
    """Every pixel (u from 1 to width, v from 1 to height) of frames (scene_id, frame, width, height)."""
    rows = frames.select("scene_id", "frame", "width", F.explode(F.sequence(F.lit(1), F.col("height"))).alias("v"))
    return rows.select("scene_id", "frame", F.explode(F.sequence(F.lit(1), F.col("width"))).alias("u"), "v")


def keep_masks(pixels: DataFrame, frame_grid: DataFrame) -> DataFrame:
    """The pixels (scene_id, frame, u, v) of a frame that no instance covers."""
    return frame_grid.join(pixels.select("scene_id", "frame", "u", "v").distinct(), ["scene_id", "frame", "u", "v"], "left_anti")


def composite_clean_plate(image: DataFrame, pixels: DataFrame, plate: DataFrame) -> DataFrame:
    """image (scene_id, frame, u, v, value) with the plate's value where an instance covers it and the plate has one."""
    key = ["scene_id", "frame", "u", "v"]
    covered = pixels.select(key).distinct().join(plate.select(*key, F.col("value").alias("_plate")), key)
    return image.join(covered, key, "left").select(*key, F.coalesce("_plate", "value").alias("value"))


def mask_votes(projected: DataFrame, pixels: DataFrame) -> DataFrame:
    """(scene_id, instance_id, point_id, votes): in how many frames a point falls on an instance's mask.

    projected has u, v (rounded half to even here), depth (over 0.05 counts), width and height. A vote is an equal pixel, so
    the join is by the whole pixel key and a frame's points are spread over its pixels.
    """
    rows = projected.select("scene_id", "frame", "point_id", F.rint("u").cast("long").alias("u"), F.rint("v").cast("long").alias("v"), "depth", "width", "height")
    rows = rows.where((F.col("depth") > 0.05) & F.col("u").between(0, F.col("width") - 1) & F.col("v").between(0, F.col("height") - 1))
    return rows.join(pixels, ["scene_id", "frame", "u", "v"]).groupBy("scene_id", "instance_id", "point_id").agg(F.count(F.lit(1)).alias("votes"))


def cloud_votes(points: DataFrame, poses: DataFrame, pixels: DataFrame) -> DataFrame:
    """mask_votes() of points (scene_id, point_id, x, y, z) and poses (turned() with frame, width and height of the masks, and su and sv, the
    image's pixels to one of a mask), without a row for a point in an image: a block of points is held and all images pass it, those in equal poses of a frame as one."""
    return vote_sums(with_cells(points.select("scene_id", "point_id", "x", "y", "z"), BLOCK), with_times(poses), pixels)


def select_voted_points(votes: DataFrame, min_votes: int = 2) -> DataFrame:
    """Points with enough votes; where fewer than 16 of an instance have them, those with one; instances with fewer than 8 even so have none."""
    counts = votes.groupBy("scene_id", "instance_id").agg(F.count_if(F.col("votes") >= min_votes).alias("_many"), F.count(F.lit(1)).alias("_all"))
    needed = F.when(F.col("_many") >= 16, min_votes).when(F.col("_all") >= 8, 1)
    return votes.join(counts, ["scene_id", "instance_id"]).where(F.col("votes") >= needed).select(votes.columns)


def best_view(areas: DataFrame) -> DataFrame:
    """The frame with the largest mask of each instance; of equal ones the first."""
    return areas.groupBy("scene_id", "instance_id").agg(F.max_by("frame", F.struct("area", -F.col("frame"))).alias("frame"), F.max("area").alias("area"))


def next_instance_id(instances: DataFrame, slug: Column) -> DataFrame:
    """The next free id of each class: its slug and the largest number so far plus one, three digits or more."""
    number = F.regexp_extract("instance_id", r"_(\d+)$", 1).try_cast("int")
    found = instances.groupBy("scene_id", slug.alias("slug")).agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("_n"))
    return found.select("scene_id", "slug", F.format_string("%s_%03d", "slug", "_n").alias("next_id"))


def review_instances(objects: DataFrame, pixels: DataFrame) -> DataFrame:
    """objects (scene_id, instance_id, merged_into) that have masks and aren't merged away, with how many frames they have."""
    masks = pixels.groupBy("scene_id", "instance_id").agg(F.count_distinct("frame").alias("masks"))
    return objects.where("merged_into IS NULL").join(masks, ["scene_id", "instance_id"])


def runs(pixels: DataFrame) -> DataFrame:
    """Masks as runs of pixels along a row: (scene_id, instance_id, frame, v, start, length)."""
    w = Window.partitionBy("scene_id", "instance_id", "frame", "v").orderBy("u")
    marked = pixels.withColumn("_group", F.col("u") - F.row_number().over(w))
    return marked.groupBy("scene_id", "instance_id", "frame", "v", "_group").agg(F.min("u").alias("start"), F.count(F.lit(1)).alias("length")).drop("_group")


def binarize_masks(values: DataFrame, threshold: int = 127) -> DataFrame:
    """Pixel rows of the mask images' pixels (PIXEL, value) that are brighter than the threshold."""
    return values.where(F.col("value") > threshold).select(*PIXEL)


def import_corrected_masks(pixels: DataFrame, objects: DataFrame, corrected: DataFrame, threshold: int = 127) -> tuple[DataFrame, DataFrame]:
    """(pixels, objects) after corrected mask images (PIXEL, value) replaced the masks of their instance and frame; the review of those
    instances starts again. A mask without a pixel above the threshold is an empty one."""
    mask, instance = ["scene_id", "instance_id", "frame"], ["scene_id", "instance_id"]
    kept = pixels.join(corrected.select(mask).distinct(), mask, "left_anti").select(*PIXEL)
    again = corrected.select(*instance, F.lit("pending").alias("_state")).distinct()
    reviewed = objects.join(again, instance, "left").select(*[F.coalesce("_state", c).alias(c) if c == "review_state" else F.col(c) for c in objects.columns])
    return kept.unionByName(binarize_masks(corrected, threshold)), reviewed


def import_masks(objects: DataFrame, tracks: DataFrame, reports: DataFrame, min_views: int) -> DataFrame:
    """objects (scene_id, instance_id, display_name, class_name, review_state, warnings) after the masks of tracks (scene_id, instance_id,
    class_name) came in: each track's object takes its class and is pending; new ones are added under the track's name. With fewer
    than min_views frames in reports (mask_report()) a warning is added once."""
    key = ["scene_id", "instance_id"]
    found = tracks.select(*key, F.col("class_name").alias("_class")).join(reports.select(*key, F.col("frames").alias("_frames")), key, "left").withColumn("_frames", F.coalesce("_frames", F.lit(0)))
    said = F.when(F.col("_frames") < min_views, F.array(F.format_string(f"Only %d valid masks; need {min_views}", F.col("_frames").cast("long")))).otherwise(F.array().cast("array<string>"))
    rows = objects.join(found, key, "full")
    taken, old = F.col("_class").isNotNull(), F.coalesce("warnings", F.array().cast("array<string>"))
    return rows.select(
        *key, F.coalesce("display_name", F.initcap(F.replace("instance_id", F.lit("_"), F.lit(" ")))).alias("display_name"), F.coalesce("_class", "class_name").alias("class_name"),
        F.when(taken, "pending").otherwise(F.col("review_state")).alias("review_state"), F.when(taken, F.array_union(old, said)).otherwise(old).alias("warnings"),
    )
