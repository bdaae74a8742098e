"""Transforms of whole scenes: boxes in other frames, metric scale, evidence and approval, new scenes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaframe.functions import geometry as G
from vistaframe.sources.tables import ship

#: Frames of a capture and of the built scene.
CAPTURE, WORLD = "colmap", "usd"
OBB = ("cx", "cy", "cz", *(f"r{k}" for k in range(9)), "hx", "hy", "hz")


def obb_corners(boxes: DataFrame) -> DataFrame:
    """boxes (OBB and others) with a row for each corner: corner (0 to 7), x, y, z."""
    rows = boxes.select("*", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("corner"))
    at = G.obb_corner([F.col(c) for c in OBB[:3]], [F.col(c) for c in OBB[3:12]], [F.col(c) for c in OBB[12:]], F.col("corner"))
    return rows.select("*", *[c.alias(n) for c, n in zip(at, "xyz", strict=True)])


def polar3(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows with the nine named columns replaced by the nearest right-handed rotation. Rows are objects: few, one 3x3 matrix each."""
    ship(rows.sparkSession)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            u, _, v = np.linalg.svd(batch[columns].to_numpy(float).reshape(-1, 3, 3))
            u[:, :, 2] *= np.sign(np.linalg.det(u @ v))[:, None]
            batch[columns] = (u @ v).reshape(-1, 9)
            yield batch

    return rows.mapInPandas(nearest, rows.schema)


def transform_obb(boxes: DataFrame, transforms: DataFrame) -> DataFrame:
    """boxes (scene_id, OBB and others) through the matrix and scale of their scene (scene_id, matrix, scale).

    Centres go through both, half sides through the scale, and axes through the matrix, made a rotation again. Boxes of scenes
    without a transform stay.
    """
    m, scale = F.col("_m"), F.col("_scale")
    rows = boxes.join(transforms.select("scene_id", G.whole_matrix(F.col("matrix")).alias("_m"), F.col("scale").alias("_scale")), "scene_id", "left")
    known = m.isNotNull()
    centre = G.apply_trained_transform([F.col(c) for c in OBB[:3]], m, scale)
    linear = [F.get(m, F.lit(4 * i + j)) for i in range(3) for j in range(3)]
    turned = [G.dot(linear[3 * i : 3 * i + 3], [F.col(f"r{3 * k + j}") for k in range(3)]) for i in range(3) for j in range(3)]
    new = dict(zip(OBB, [*centre, *turned, *[F.col(c) * scale for c in OBB[12:]]], strict=True))
    moved = rows.select(*[F.when(known, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in boxes.columns])
    return polar3(moved, list(OBB[3:12]))


def saved_to_trained(rows: DataFrame, full: str, applied: str, name: str = "matrix") -> DataFrame:
    """rows with the transform from saved coordinates to trained ones: the full matrix after undoing the one that was applied at saving
    (3x4 or 4x4; null: nothing was). Rows are scenes. A matrix without inverse gives null terms."""
    eye = [1.0 if k % 5 == 0 else 0.0 for k in range(16)]
    whole = lambda c: F.array(*[F.coalesce(F.get(c, F.lit(k)), F.lit(eye[k])) for k in range(16)])
    g = lambda c, i, j: F.get(c, F.lit(4 * i + j))
    rows = rows.withColumns({"_f": whole(full), "_a": whole(applied)})
    a, b, c = ([g("_a", i, k) for i in range(3)] for k in range(3))
    turned = F.array(*[x for p, q in ((b, c), (c, a), (a, b)) for x in G.cross(p, q)])
    rows = rows.withColumn("_r", turned)
    rows = rows.withColumn("_det", F.nullif(G.dot(a, [F.get("_r", F.lit(k)) for k in range(3)]), F.lit(0.0)))
    rows = rows.withColumn("_r", F.transform("_r", lambda x: x / F.col("_det")))
    linear = [[F.get("_r", F.lit(3 * i + j)) for j in range(3)] for i in range(3)]
    shift = [g("_a", i, 3) for i in range(3)]
    rows = rows.withColumn("_i", G.matrix_of([x for r in linear for x in r], [-G.dot(r, shift) for r in linear]))
    return rows.withColumn(name, G.matmul44(F.col("_f"), F.col("_i"))).drop("_f", "_a", "_r", "_det", "_i")


def source_to_target(scenes: DataFrame, paths: DataFrame, source: str = CAPTURE, target: str = WORLD) -> DataFrame:
    """(scene_id, matrix, warning) of scenes (scene_id, build_mode): the path between two frames.

    A scene without one gets the identity and a warning; in production mode it is an error. paths: from frame_paths().
    """
    own = paths.where((F.col("source") == source) & (F.col("target") == target)).select("scene_id", F.col("matrix").alias("_m"))
    eye = F.array(*[F.lit(1.0 if k % 5 == 0 else 0.0) for k in range(16)])
    missing = F.raise_error(F.concat(F.lit(f"no transform from {source} to {target} in scene "), F.col("scene_id"))).cast("array<double>")
    rows = scenes.join(own, "scene_id", "left")
    matrix = F.coalesce("_m", F.when(F.col("build_mode") == "production", missing).otherwise(eye))
    return rows.select("scene_id", matrix.alias("matrix"), F.when(F.col("_m").isNull(), f"no transform from {source} to {target}").alias("warning"))


def resolve_floor_transform(scenes: DataFrame, floors: DataFrame, transforms: DataFrame) -> DataFrame:
    """(scene_id, evidence): the floor's own file (scene_id, path) where there is one, else the first evidence of the scene's transforms
    (scene_id, ordinal, evidence, file_exists) that exists; null without either."""
    first = transforms.where("evidence IS NOT NULL AND file_exists").groupBy("scene_id").agg(F.min_by("evidence", "ordinal").alias("_other"))
    own = floors.groupBy("scene_id").agg(F.min("path").alias("_own"))
    return scenes.select("scene_id").join(own, "scene_id", "left").join(first, "scene_id", "left").select("scene_id", F.coalesce("_own", "_other").alias("evidence"))


def set_metric_transform(transforms: DataFrame, scales: DataFrame, approvals: DataFrame, new: DataFrame, reviewer: str, method: str = "approved_similarity_registration") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(transforms, scales, approvals) after new (scene_id, matrix, confidence, evidence) became each scene's capture-to-world edge.

    The scene's former edge goes, the new one comes last; the scale is that of the matrix and approved; the gate
    metric_transform is approved. A matrix that is no similarity is an error. Scenes not in new stay.
    """
    checked = F.when(G.is_similarity(F.col("matrix")), F.col("matrix")).otherwise(F.raise_error(F.concat(F.lit("no similarity transform in scene "), F.col("scene_id"))).cast("array<double>"))
    new = new.select("scene_id", checked.alias("matrix"), "confidence", "evidence")
    replaced = transforms.join(new.select("scene_id", F.lit(CAPTURE).alias("source_frame"), F.lit(WORLD).alias("target_frame")), ["scene_id", "source_frame", "target_frame"], "left_anti")
    last = transforms.groupBy("scene_id").agg((F.max("ordinal") + 1).alias("_last"))
    edges = new.join(last, "scene_id", "left").select("scene_id", F.coalesce("_last", F.lit(0)).cast(transforms.schema["ordinal"].dataType).alias("ordinal"), F.lit(CAPTURE).alias("source_frame"), F.lit(WORLD).alias("target_frame"), "matrix", "confidence", "evidence")
    own = new.select("scene_id", F.lit(method).alias("method"), G.uniform_scale(F.col("matrix")).alias("meters_per_unit"), "confidence", F.col("evidence").alias("reference"), F.lit(True).alias("approved"))
    gate = new.select("scene_id", F.lit("metric_transform").alias("gate"), F.lit("approved").alias("state"), F.lit(reviewer).alias("reviewer"))
    return (
        replaced.select(edges.columns).unionByName(edges),
        scales.join(new, "scene_id", "left_anti").select(own.columns).unionByName(own),
        approvals.join(gate, ["scene_id", "gate"], "left_anti").select(gate.columns).unionByName(gate),
    )


def metric_scene_state(scenes: DataFrame, clouds: DataFrame, floors: DataFrame, scales: DataFrame, approvals: DataFrame) -> DataFrame:
    """For each scene what the metric step has: a cloud, a floor matrix of four rows, an approved scale (by itself or by its gate), the scale
    and how it came about; ready with a cloud and a floor. Tables are keyed by scene_id; floors has matrix rows as an array."""
    cloud = clouds.select("scene_id", F.lit(True).alias("_cloud")).distinct()
    floor = floors.groupBy("scene_id").agg(F.bool_or(F.size("matrix").isin(4, 16)).alias("_floor"))
    gate = approvals.where("gate = 'metric_transform'").groupBy("scene_id").agg(F.bool_or(F.col("state") == "approved").alias("_gate"))
    rows = scenes.select("scene_id").join(cloud, "scene_id", "left").join(floor, "scene_id", "left").join(scales.select("scene_id", "method", "meters_per_unit", "approved"), "scene_id", "left").join(gate, "scene_id", "left")
    has = lambda c: F.coalesce(c, F.lit(False))
    return rows.select("scene_id", has("_cloud").alias("has_cloud"), has("_floor").alias("has_floor"), (has("approved") | has("_gate")).alias("approved"), F.col("meters_per_unit").alias("scale"), F.col("method").alias("scale_method"), (has("_cloud") & has("_floor")).alias("ready"))


def init_scenes(options: DataFrame) -> dict[str, DataFrame]:
    """scenes, captures, scales, transforms and warnings of new scenes.

    options: scene_id, build_mode, path, modality, calibration_path, scale_anchor_m, clean_plate_path, and of the calibration
    file matrix, meters_per_unit, registration_confidence, calibration_approved, all null where there is none. A calibrated
    registration sets the scale before a metric sensor (depth or lidar), and that before a known length still to be measured.
    """
    calibrated, sensor, anchored = F.col("matrix").isNotNull(), F.col("modality").isin("rgbd", "lidar"), F.col("scale_anchor_m").isNotNull()
    sure = F.coalesce("registration_confidence", F.lit(1.0))
    pick = lambda a, b, c, d: F.when(calibrated, a).when(sensor, b).when(anchored, c).otherwise(d)
    scale = options.select(
        "scene_id", pick(F.lit("calibrated_registration"), F.lit("metric_sensor"), F.lit("known_length_pending_measurement"), F.lit("unknown")).alias("method"),
        pick(F.coalesce("meters_per_unit", F.lit(1.0)), F.lit(1.0), F.lit(None), F.lit(None)).cast("double").alias("meters_per_unit"), pick(sure, F.lit(0.95), F.lit(0.5), F.lit(0.0)).alias("confidence"),
        pick(F.col("calibration_path"), F.coalesce("calibration_path", "modality"), F.concat(F.col("scale_anchor_m").cast("string"), F.lit(" m anchor")), F.lit(None)).alias("reference"),
        pick(F.coalesce("calibration_approved", F.lit(True)), F.lit(True), F.lit(False), F.lit(False)).alias("approved"),
    )
    capture = options.select("scene_id", F.lit("scene").alias("capture_id"), "path", "modality", "calibration_path", F.lit(True).alias("registered"))
    plate = options.where("clean_plate_path IS NOT NULL").select("scene_id", F.lit("clean_plate").alias("capture_id"), F.col("clean_plate_path").alias("path"), "modality", F.lit(None).cast("string").alias("calibration_path"), F.lit(False).alias("registered"))
    edges = options.where(calibrated).select("scene_id", F.lit(0).alias("ordinal"), F.lit(CAPTURE).alias("source_frame"), F.lit(WORLD).alias("target_frame"), "matrix", sure.alias("confidence"), F.col("calibration_path").alias("evidence"))
    warnings = options.where(~calibrated).select("scene_id", F.lit("no metric transform: production export stays blocked until calibration or review gives one").alias("warning"))
    scenes = options.select("scene_id", "build_mode", F.lit("pending").alias("review_state"))
    return {"scenes": scenes, "captures": capture.unionByName(plate), "scales": scale, "transforms": edges, "warnings": warnings}
