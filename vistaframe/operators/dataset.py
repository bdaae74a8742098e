"""Frame curation, leakage-safe splits, label resolution and dataset mixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaframe.functions.names import frame_label_key, hash_bucket
from vistaframe.operators.places import with_places


def frame_qc(frames: DataFrame, min_sharpness: float = 0.0, min_features: int = 0) -> DataFrame:
    """frames with reason: blur before features, null for frames that stay; a threshold of 0 is off."""
    blur = F.when(F.lit(min_sharpness > 0) & (F.col("sharpness") < min_sharpness), "blur")
    few = F.when(F.lit(min_features > 0) & (F.col("features") < min_features), "features")
    return frames.withColumn("reason", F.coalesce(blur, few))


def stride_filter(frames: DataFrame, stride: int, at: str) -> DataFrame:
    return frames.where(F.col(at) % stride == 0)


def saved_ordinal(checked: DataFrame, key: str, order: str, most: int | None = None) -> DataFrame:
    """The frames that stay, numbered from 1 in order within their key, up to `most`."""
    kept = with_places(checked.where("reason IS NULL"), key, [order], "saved").withColumn("saved", F.col("saved") + 1)
    return kept if most is None else kept.where(F.col("saved") <= most)


def keyframe_subsample(saved: DataFrame, every: int) -> DataFrame:
    return saved.where((F.col("saved") - 1) % every == 0)


def frame_qc_summary(checked: DataFrame, key: str) -> DataFrame:
    rejected = lambda why: F.count_if(F.coalesce(F.col("reason") == why, F.lit(False)))
    return checked.groupBy(key).agg(F.count(F.lit(1)).alias("considered"), F.count_if(F.col("reason").isNull()).alias("kept"), rejected("blur").alias("rejected_blur"), rejected("features").alias("rejected_features"))


def held_out_views(images: DataFrame, ratio: float, key: str = "scene_id", name: str = "name") -> DataFrame:
    """Every k-th image of a scene in order of name, k being 1 / ratio rounded half to even and 2 at least; none if ratio is 0 or less."""
    if ratio <= 0:
        return images.limit(0)
    every = max(2, round(1 / ratio))
    return with_places(images, key, [name]).where(F.col("_at") % every == 0).drop("_at")


def _ranked_choice(keys: DataFrame, name: str, ratio: float, seed: int) -> DataFrame:
    """The distinct keys with val: the first max(1, n * ratio) of them in order of a hash.

    The hash is cut into ranges by its first four digits. Counts by range say in which one the cut lies, and only keys of
    that one are ranked.
    """
    hashed = keys.select(name, F.sha2(F.concat(F.lit(f"{seed}:"), F.col(name)).cast("binary"), 256).alias("_hash")).withColumn("_range", F.substring("_hash", 1, 4))
    ranges = hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranges.select("_range", (F.greatest(F.lit(1), F.floor(F.sum("_n").over(everything) * ratio)) - before).alias("_left"), "_n")
    rows = hashed.join(placed, "_range")
    whole = rows.where((F.col("_left") <= 0) | (F.col("_left") >= F.col("_n"))).select(name, (F.col("_left") > 0).alias("val"))
    cut = rows.where((F.col("_left") > 0) & (F.col("_left") < F.col("_n")))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy("_hash", name))
    return whole.unionByName(cut.select(name, (rank <= F.col("_left")).alias("val")))


def assign_split(frames: DataFrame, strategy: str = "session", val_sessions: list[str] | None = None, ratio: float = 0.2, seed: int = 0) -> DataFrame:
    """frames (session, path and others) with split.

    By session: the named ones are val; without names, sessions are ranked by a hash and the first share is val; with one
    session, each frame by its own hash. By frame, or where one side would be empty: frames are ranked by a hash. Frames are
    joined back by key, so no session is split over both sides.
    """
    if strategy == "session":
        if val_sessions:
            split = frames.withColumn("_val", F.col("session").isin(*val_sessions))
        elif frames.select("session").distinct().limit(2).count() < 2:
            split = frames.withColumn("_val", hash_bucket(frame_label_key(F.col("path")), seed) < ratio)
        else:
            ranked = _ranked_choice(frames.select("session").distinct(), "session", ratio, seed).withColumnRenamed("val", "_val")
            split = frames.join(ranked, "session")
        if split.select("_val").distinct().count() == 2:
            return split.withColumn("split", F.when(F.col("_val"), "val").otherwise("train")).select(*frames.columns, "split")
    ranked = _ranked_choice(frames.select("path").distinct(), "path", ratio, seed)
    return frames.join(ranked, "path").withColumn("split", F.when(F.col("val"), "val").otherwise("train")).select(*frames.columns, "split")


def resolve_labels(images: DataFrame, labels: DataFrame) -> DataFrame:
    """images (key, index) with the label_key of labels they have: their own, or frame_{index - 1} where index is 1 or more."""
    names = labels.select("label_key").distinct()
    fallback = F.when(F.col("index") >= 1, F.format_string("frame_%06d", F.col("index") - 1))
    own = images.join(names.select(F.col("label_key").alias("key"), F.lit(True).alias("_own")), "key", "left").withColumn("_fallback", fallback)
    both = own.join(names.select(F.col("label_key").alias("_fallback"), F.lit(True).alias("_other")), "_fallback", "left")
    return both.select(*images.columns, F.when(F.col("_own"), F.col("key")).when(F.col("_other"), F.col("_fallback")).alias("label_key"))


def resolve_by_priority(rows: DataFrame, files: DataFrame, candidates: list[Column], key: list[str]) -> DataFrame:
    """rows with the file (path of files) that is the first of the candidate names to exist in the row's key."""
    named = rows.select("*", F.posexplode(F.array(*candidates)).alias("_at", "path"))
    found = named.join(files.select(*key, "path").distinct(), [*key, "path"]).groupBy(*rows.columns).agg(F.min_by("path", "_at").alias("path"))
    return rows.join(found, rows.columns, "left")


def mixed_dataset(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Real and synthetic train rows and real val rows; of one name and split the synthetic row wins."""
    both = real.withColumn("_order", F.lit(0)).unionByName(synthetic.where("split = 'train'").withColumn("_order", F.lit(1)))
    return both.groupBy("split", "name").agg(F.max_by(F.struct(*real.columns), "_order").alias("_row")).select("_row.*")


def attach_real_val(synthetic: DataFrame, real: DataFrame) -> DataFrame:
    """The synthetic train rows with the real val rows."""
    return synthetic.where("split = 'train'").unionByName(real.where("split = 'val'").select(synthetic.columns))


def real_dataset(frames: DataFrame, labels: DataFrame, captures: DataFrame | None = None, **split) -> DataFrame:
    """(split, label_key, path, ordinal, class_id, xc, yc, w, h): frames (session, path, key, index) with their split and labels.

    labels (label_key, ordinal, class_id, xc, yc, w, h) are found by resolve_labels(); an image without labels is one row of nulls. The
    image of the capture (captures: key, path) is preferred to the raw frame of the same key. split: of assign_split().
    """
    placed = assign_split(frames, **split)
    named = resolve_labels(placed, labels).withColumnRenamed("label_key", "_labels")
    if captures is not None:
        named = named.join(captures.select("key", F.col("path").alias("_image")), "key", "left").withColumn("path", F.coalesce("_image", "path"))
    rows = named.join(labels.withColumnRenamed("label_key", "_labels"), "_labels", "left")
    return rows.select("split", F.col("key").alias("label_key"), "path", "ordinal", "class_id", "xc", "yc", "w", "h")


def synthetic_labels(objects: DataFrame, poses: DataFrame) -> DataFrame:
    """(scene_id, image_id, object_id, class_id, xc, yc, w, h): the objects (object_id, class_id, lo_x..hi_z) of a scene in each of its
    poses (with cameras) that shows them."""
    from vistaframe.functions import geometry as G
    from vistaframe.operators.boxes import project_aabb_to_label
    from vistaframe.operators.cameras import quaternion

    r = G.quat_to_rotmat(quaternion())
    turned = poses.select("scene_id", "image_id", *[c.alias(f"r{k}") for k, c in enumerate(r)], "tx", "ty", "tz", "fx", "fy", "cx", "cy", "width", "height")
    found = project_aabb_to_label(turned.join(objects, "scene_id"))
    return found.where("label IS NOT NULL").select("scene_id", "image_id", "object_id", "class_id", "label.*")


def synthetic_dataset(renders: DataFrame, labels: DataFrame) -> DataFrame:
    """(split, label_key, path, ordinal, class_id, xc, yc, w, h): renders (scene_id, image_id, path) as train images named synth_000000 and on, in
    order of scene and image, with their synthetic_labels(). A render without labels is one row of nulls."""
    sizes = renders.groupBy("scene_id").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("scene_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("scene_id").orderBy("image_id")) - 1
    named = renders.withColumn("_at", inside).join(before, "scene_id").withColumn("label_key", F.format_string("synth_%06d", F.col("_at") + F.col("_before")))
    rows = named.join(labels, ["scene_id", "image_id"], "left")
    return rows.select(F.lit("train").alias("split"), "label_key", "path", F.col("object_id").alias("ordinal"), "class_id", "xc", "yc", "w", "h")


def stage_training_set(images: DataFrame, pixels: DataFrame, masks: DataFrame, plates: DataFrame, ratio: float) -> tuple[DataFrame, DataFrame]:
    """(frames, pixels): images (scene_id, frame, name, frame_pixels) with held_out and the share of masked pixels, and image pixels (scene_id,
    frame, u, v, value) with the plate where an instance covers it; keep says whether a pixel trains: not covered, or replaced."""
    from vistaframe.operators.masks import composite_clean_plate

    key = ["scene_id", "frame", "u", "v"]
    out = held_out_views(images, ratio).select("scene_id", "frame", F.lit(True).alias("_out"))
    covered = masks.select(key).distinct()
    share = covered.groupBy("scene_id", "frame").agg(F.count(F.lit(1)).alias("_n"))
    frames = images.join(out, ["scene_id", "frame"], "left").join(share, ["scene_id", "frame"], "left")
    frames = frames.select(*images.columns, F.coalesce("_out", F.lit(False)).alias("held_out"), (F.coalesce("_n", F.lit(0)) / F.col("frame_pixels")).alias("masked"))
    replaced = plates.select(*key, F.lit(True).alias("_plate"))
    staged = composite_clean_plate(pixels, masks, plates).join(covered.withColumn("_covered", F.lit(True)), key, "left").join(replaced, key, "left")
    return frames, staged.select(*key, "value", (F.col("_covered").isNull() | F.col("_plate").isNotNull()).alias("keep"))


def resolve_renders(held_out: DataFrame, renders: DataFrame, key: list[str]) -> DataFrame:
    """held_out (key, name) with the render of that name, or of its stem with .png, .jpg or .jpeg, the first that exists."""
    from vistaframe.functions.names import stem

    base = stem(F.col("name"))
    return resolve_by_priority(held_out, renders, [F.col("name"), *[F.concat(base, F.lit(e)) for e in (".png", ".jpg", ".jpeg")]], key)


def resolve_clean_plates(images: DataFrame, plates: DataFrame, key: list[str]) -> DataFrame:
    """images (key, name) with the plate of that name, or of its stem with .png or .jpg, the first that exists."""
    from vistaframe.functions.names import stem

    base = stem(F.col("name"))
    return resolve_by_priority(images, plates, [F.col("name"), *[F.concat(base, F.lit(e)) for e in (".png", ".jpg")]], key)
