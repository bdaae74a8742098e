"""Nested JSON documents (manifests, tracks, trials, transforms) as flat tables, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.sources.sfm import scene_of
from vistaframe.sources.versions import Folder, replace_json

MANIFEST = """scene_name string, build_mode string, review_state string,
scale struct<method: string, meters_per_unit: double, confidence: double, approved: boolean>,
captures array<struct<capture_id: string, modality: string, path: string>>,
transforms array<struct<source_frame: string, target_frame: string, matrix: array<array<double>>, confidence: double, evidence: string>>,
objects array<struct<instance_id: string, class_name: string, movable: boolean, review_state: string, observed_background_coverage: double, physics: map<string, string>>>,
artifacts array<struct<artifact_id: string, path: string, metadata: map<string, string>>>,
approvals map<string, struct<state: string, reviewer: string, notes: string, timestamp: string>>"""
CHILDREN = ("captures", "transforms", "objects", "artifacts")
TRACKS = "instances array<struct<instance_id: string, class_name: string, confidence: double, detections: array<struct<frame: string, class_name: string, confidence: double, xyxy: array<double>, source: string>>>>"
TRIALS = "trials array<struct<trial_id: string, kind: string, status: string, quality_score: double, params: map<string, string>, metrics: map<string, string>>>"


def documents(spark: SparkSession, path: str, schema: str, name: str, mode: str = "FAILFAST") -> DataFrame:
    """A row for each file of that name, with its scene; of a versioned folder those of the version that counts."""
    folder = Folder(spark, path)
    path = path if folder.current() is None else folder.latest()
    files = spark.read.schema(schema).option("multiLine", "true").option("mode", mode).option("recursiveFileLookup", "true").option("pathGlobFilter", name).json(path)
    return files.select(scene_of(F.col("_metadata.file_path")).alias("scene_id"), *files.columns)


def read_manifest(spark: SparkSession, path: str, name: str = "manifest.json") -> dict[str, DataFrame]:
    """scenes, captures, transforms, objects, artifacts (each with its ordinal) and approvals. A file that doesn't fit the schema is an error."""
    rows = documents(spark, path, MANIFEST, name)
    found = {"scenes": rows.select("scene_id", "scene_name", "build_mode", "review_state", "scale.*")}
    for child in CHILDREN:
        found[child] = rows.select("scene_id", F.posexplode(child).alias("ordinal", "_c")).select("scene_id", "ordinal", "_c.*")
    found["approvals"] = rows.select("scene_id", F.explode("approvals").alias("gate", "_a")).select("scene_id", "gate", "_a.*")
    return found


def write_manifest(tables: dict[str, DataFrame], path: str) -> None:
    """One JSON document for each scene, under scene_id=... of a new version of path; readers of Folder.latest() see the old one until it is whole."""
    scenes = tables["scenes"]
    nested = scenes.select("scene_id", "scene_name", "build_mode", "review_state", F.struct("method", "meters_per_unit", "confidence", "approved").alias("scale"))
    for child in CHILDREN:
        own = [c for c in tables[child].columns if c not in ("scene_id", "ordinal")]
        lists = tables[child].groupBy("scene_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", F.struct(*own).alias("r")))), lambda x: x["r"]).alias(child)) if not _has_map(tables[child]) else _with_maps(tables[child], own, child)
        nested = nested.join(lists, "scene_id", "left")
    gates = tables["approvals"].groupBy("scene_id").agg(F.map_from_entries(F.collect_list(F.struct("gate", F.struct("state", "reviewer", "notes", "timestamp")))).alias("approvals"))
    replace_json(nested.join(gates, "scene_id", "left"), path, "scene_id")


def _has_map(df: DataFrame) -> bool:
    return any(kind.startswith("map") for _, kind in df.dtypes)


def _with_maps(df: DataFrame, own: list[str], child: str) -> DataFrame:
    """Maps can't be compared, so rows are put in order by their ordinal alone, through a map from it."""
    by_place = F.map_from_entries(F.collect_list(F.struct("ordinal", F.struct(*own).alias("r"))))
    places = F.array_sort(F.collect_list("ordinal"))
    lists = df.groupBy("scene_id").agg(by_place.alias("_m"), places.alias("_p"))
    return lists.select("scene_id", F.transform("_p", lambda p: F.element_at("_m", p)).alias(child))


def read_tracks(spark: SparkSession, path: str, name: str = "instances.json") -> DataFrame:
    """A row for each detection of each instance."""
    rows = documents(spark, path, TRACKS, name).select("scene_id", F.explode("instances").alias("i"))
    rows = rows.select("scene_id", "i.instance_id", F.col("i.confidence").alias("track_confidence"), F.posexplode("i.detections").alias("ordinal", "d"))
    box = [F.get("d.xyxy", k).alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"))]
    return rows.select("scene_id", "instance_id", "track_confidence", "ordinal", "d.frame", "d.class_name", "d.confidence", *box, "d.source")


def write_tracks(tracks: DataFrame, path: str) -> None:
    detection = F.struct("ordinal", F.struct("frame", "class_name", "confidence", F.array("x0", "y0", "x1", "y1").alias("xyxy"), "source").alias("d"))
    one = tracks.groupBy("scene_id", "instance_id").agg(F.min_by("class_name", "ordinal").alias("class_name"), F.first("track_confidence").alias("confidence"), F.transform(F.array_sort(F.collect_list(detection)), lambda x: x["d"]).alias("detections"))
    whole = one.groupBy("scene_id").agg(F.array_sort(F.collect_list(F.struct("instance_id", "class_name", "confidence", "detections"))).alias("instances"))
    replace_json(whole, path, "scene_id")


def read_trials(spark: SparkSession, path: str, name: str = "trials.json") -> DataFrame:
    rows = documents(spark, path, TRIALS, name).select("scene_id", F.posexplode("trials").alias("ordinal", "t"))
    return rows.select("scene_id", "ordinal", "t.*")


def read_transform(spark: SparkSession, path: str, name: str = "transform.json") -> DataFrame:
    """(scene_id, matrix): the 4x4 matrix under colmap_to_usd or matrix; an error if it is no similarity."""
    from vistaframe.functions.geometry import is_similarity

    rows = documents(spark, path, "colmap_to_usd array<array<double>>, matrix array<array<double>>", name)
    flat = rows.select("scene_id", F.flatten(F.coalesce("colmap_to_usd", "matrix")).alias("matrix"))
    bad = F.raise_error(F.concat(F.lit("no similarity transform in scene "), F.col("scene_id"))).cast("array<double>")
    return flat.select("scene_id", F.when(is_similarity(F.col("matrix")), F.col("matrix")).otherwise(bad).alias("matrix"))


def write_camera_path(poses: DataFrame, path: str, fps: int = 24) -> None:
    """One JSON document for each scene: its poses (ordinal, c2w, fov, aspect) in order, for a film of one frame each."""
    frames = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", F.struct(F.col("c2w").alias("camera_to_world"), "fov", "aspect").alias("f")))), lambda x: x["f"])
    whole = poses.groupBy("scene_id").agg(frames.alias("camera_path"), F.lit(fps).alias("fps"), (F.greatest(F.count(F.lit(1)), F.lit(1)) / fps).alias("seconds"))
    replace_json(whole, path, "scene_id")


def write_trials(trials: DataFrame, path: str) -> None:
    """One JSON document of trials for each scene, in their order."""
    own = [c for c in trials.columns if c not in ("scene_id", "ordinal")]
    replace_json(_with_maps(trials, own, "trials"), path, "scene_id")
