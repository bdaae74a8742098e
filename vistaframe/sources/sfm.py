"""Text exports of structure-from-motion tools, camera frames and PLY clouds as tables keyed by scene.

A scene is the folder its file lies in. Files are read as splittable text; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.sources.ply import read_ply, write_ply
from vistaframe.sources.versions import Folder, replace_json

NUMBER = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"
#: An image's pose line: ten tokens, of which the last isn't a number. Lines of 2D points are numbers only, or empty.
POSE_LINE = rf"^\s*\d+(\s+{NUMBER}){{7}}\s+\d+\s+(?!{NUMBER}\s*$)\S+\s*$"


def decoded(name: Column) -> Column:
    """A file's or folder's name from a URI; a plus sign stands for itself there."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def scene_of(path: Column) -> Column:
    return decoded(F.regexp_extract(path, r"(?:scene_id=)?([^/]+)/[^/]+$", 1))


def lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(scene_id, value, tokens, place) of the lines that are no comment and not blank."""
    text = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path)
    rows = text.select(scene_of(F.col("_metadata.file_path")).alias("scene_id"), "value", F.monotonically_increasing_id().alias("place"))
    rows = rows.where(~F.col("value").rlike(r"^\s*(#|$)"))
    return rows.withColumn("tokens", F.split(F.trim("value"), r"\s+"))


def token(k: int, kind: str) -> Column:
    return F.element_at("tokens", k).cast(kind)


def read_sfm_cameras(spark: SparkSession, path: str) -> DataFrame:
    """scene_id, camera_id, model, width, height, params."""
    rows = lines(spark, path, "cameras.txt")
    params = F.transform(F.slice("tokens", 5, F.size("tokens")), lambda t: t.cast("double"))
    return rows.select("scene_id", token(1, "int").alias("camera_id"), token(2, "string").alias("model"), token(3, "int").alias("width"), token(4, "int").alias("height"), params.alias("params"))


def read_sfm_images(spark: SparkSession, path: str) -> DataFrame:
    """scene_id, image_id, qw..qz, tx..tz, camera_id, name. Lines are told apart by their shape, so an image without 2D points
    swallows no other; of images with one name the last stays."""
    rows = lines(spark, path, "images.txt").where(F.col("value").rlike(POSE_LINE))
    terms = ("qw", "qx", "qy", "qz", "tx", "ty", "tz")
    poses = rows.select("scene_id", "place", token(1, "long").alias("image_id"), *[token(k, "double").alias(c) for k, c in enumerate(terms, 2)], token(9, "int").alias("camera_id"), token(10, "string").alias("name"))
    last = F.max_by(F.struct("image_id", *terms, "camera_id"), "place").alias("p")
    return poses.groupBy("scene_id", "name").agg(last).select("scene_id", "p.*", "name")


def read_sfm_points(spark: SparkSession, path: str, rgb: bool = False) -> DataFrame:
    """scene_id, point_id, x, y, z and, with rgb, r, g, b of the rows that have colours."""
    rows = lines(spark, path, "points3D.txt")
    columns = [token(1, "long").alias("point_id"), *[token(k, "double").alias(c) for k, c in enumerate("xyz", 2)]]
    if not rgb:
        return rows.select("scene_id", *columns)
    return rows.where(F.size("tokens") >= 7).select("scene_id", *columns, *[token(k, "smallint").alias(c) for k, c in enumerate("rgb", 5)])


def read_sfm(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cameras, images and points; an error if there is no point at all."""
    points = read_sfm_points(spark, path)
    if points.isEmpty():
        raise ValueError(f"no points under {path}")
    return read_sfm_cameras(spark, path), read_sfm_images(spark, path), points


FRAMES = "frames array<struct<file_path: string, transform_matrix: array<array<double>>>>, applied_transform array<array<double>>, w double, h double, fl_x double, fl_y double, cx double, cy double, camera_angle_x double, camera_model string"


def read_camera_frames(spark: SparkSession, path: str) -> DataFrame:
    """A row for each frame of transforms.json, or of transforms_train.json where a scene has no other: ordinal, file_path,
    c2w and applied_transform as 16 numbers in row order (3x4 matrices completed), and the intrinsics."""
    files = spark.read.schema(FRAMES).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "transforms*.json").json(path)
    named = files.withColumns({"scene_id": scene_of(F.col("_metadata.file_path")), "_train": F.col("_metadata.file_name") != "transforms.json"})
    one = named.groupBy("scene_id").agg(F.min_by(F.struct(*files.columns), "_train").alias("f")).select("scene_id", "f.*")

    def whole(m: Column) -> Column:
        flat = F.flatten(m)
        return F.when(F.size(flat) == 12, F.concat(flat, F.array(*[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)]))).when(F.size(flat) == 16, flat)

    rows = one.select("scene_id", F.posexplode("frames").alias("ordinal", "_frame"), whole(F.col("applied_transform")).alias("applied_transform"), "w", "h", "fl_x", "fl_y", "cx", "cy", "camera_angle_x", "camera_model")
    return rows.select("scene_id", "ordinal", F.regexp_replace("_frame.file_path", r"^(\./)+", "").alias("file_path"), whole(F.col("_frame.transform_matrix")).alias("c2w"), *rows.columns[3:])


def read_ply_points(spark: SparkSession, path: str, pattern: str = "*.ply") -> DataFrame:
    """scene_id, point_id, x, y, z of PLY files, a binary file by several tasks; see ply.read_ply()."""
    return read_ply(spark, path, ["x", "y", "z"], pattern)


def read_labels2d(spark: SparkSession, path: str) -> DataFrame:
    """label_key, ordinal, class_id, xc, yc, w, h: the lines of five tokens of each label file."""
    text = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").text(path)
    rows = text.select(decoded(F.regexp_extract("_metadata.file_name", r"^(.*)\.txt$", 1)).alias("label_key"), F.monotonically_increasing_id().alias("ordinal"), F.split(F.trim("value"), r"\s+").alias("tokens"))
    numbers = [F.element_at("tokens", k).try_cast("double") for k in range(1, 6)]
    return rows.where(F.size("tokens") == 5).select("label_key", "ordinal", numbers[0].cast("int").alias("class_id"), *[x.alias(c) for x, c in zip(numbers[1:], ("xc", "yc", "w", "h"), strict=True)]).where("class_id IS NOT NULL")


def write_labels2d(labels: DataFrame, keys: DataFrame, path: str) -> None:
    """A folder of text for each label_key of keys: a line for each label, none for keys without labels."""
    line = F.format_string("%d %.6f %.6f %.6f %.6f", "class_id", "xc", "yc", "w", "h")
    rows = labels.groupBy("label_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", line.alias("line")))), lambda x: x["line"]), "\n").alias("value"))
    keys.select("label_key").distinct().join(rows, "label_key", "left").select("label_key", F.coalesce("value", F.lit("")).alias("value")).write.mode("overwrite").partitionBy("label_key").text(path)


def list_frames(spark: SparkSession, path: str) -> DataFrame:
    """scene_id, path, length of the images under a folder, by their endings in lower or upper case."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return files.where(F.regexp_extract("path", r"\.([^./]*)$", 1).isin("jpg", "jpeg", "png", "JPG", "JPEG", "PNG")).select(scene_of(F.col("path")).alias("scene_id"), "path", "length")


def content_hash(spark: SparkSession, path: str) -> DataFrame:
    """path and SHA-256 of the files under a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def read_reports(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON report for each file; one that is no JSON is a row of nulls, and a scene without file has none."""
    folder = Folder(spark, path)
    files = spark.read.schema(schema).option("multiLine", "true").option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").json(path if folder.current() is None else folder.latest())
    return files.select(scene_of(F.col("_metadata.file_path")).alias("scene_id"), *files.columns)


def write_reports(reports: DataFrame, path: str) -> None:
    """One JSON document for each scene, in place of what a versioned folder holds."""
    replace_json(reports, path, "scene_id")


def has_frames(spark: SparkSession, path: str) -> DataFrame:
    """(scene_id, frames) of the folders that hold an image at all."""
    return list_frames(spark, path).groupBy("scene_id").agg(F.count(F.lit(1)).alias("frames"))


DETECTIONS = "frame string, cls array<int>, conf array<double>, xyxy array<array<double>>, names map<string, string>"


def read_detections(spark: SparkSession, path: str, classes: list[str]) -> DataFrame:
    """scene_id, frame, ordinal, class_name, confidence, x0..y1 of a detector's results, a JSON line for each frame.

    A class is named by classes, else by the model's own names, else by its number as text.
    """
    files = spark.read.schema(DETECTIONS).option("recursiveFileLookup", "true").json(path)
    rows = files.select(scene_of(F.col("_metadata.file_path")).alias("scene_id"), F.regexp_extract("frame", r"([^/]+)$", 1).alias("frame"), "names", F.posexplode(F.arrays_zip("cls", "conf", "xyxy")).alias("ordinal", "d"))
    given = F.get(F.array(*[F.lit(c) for c in classes]).cast("array<string>"), F.col("d.cls"))
    own = F.try_element_at("names", F.col("d.cls").cast("string"))
    name = F.coalesce(F.when(F.col("d.cls") >= 0, given), own, F.col("d.cls").cast("string"))
    return rows.select("scene_id", "frame", "ordinal", name.alias("class_name"), F.col("d.conf").alias("confidence"), *[F.get("d.xyxy", k).alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"))])


def label_key_from_image_name(name: Column) -> Column:
    """The key of an image's labels from its name in the reconstruction: no suffix, folders joined by underscores."""
    from vistaframe.functions.names import frame_label_key

    return frame_label_key(name)


def write_ply_points(points: DataFrame, path: str) -> None:
    """Little-endian PLY of float x, y, z under path/scene_id=.../part-*.ply, points in order of id; see ply.write_ply()."""
    write_ply(points, path)


GAUSSIAN = ("x", "y", "z", "opacity", "sx", "sy", "sz", "qw", "qx", "qy", "qz")


def read_gaussians(spark: SparkSession, path: str, width: int | None = None) -> DataFrame:
    """scene_id, gaussian_id, GAUSSIAN and sh (an array for each Gaussian) of Parquet exports of whole clouds.

    An export has positions, scales and orientations as arrays of triples and quadruples, opacities, and packed coefficients sh_coeffs
    of which width (by default their number over that of positions) belong to each Gaussian.
    """
    files = spark.read.option("recursiveFileLookup", "true").parquet(path)
    rows = files.select(scene_of(F.col("_metadata.file_path")).alias("scene_id"), "*")
    each = F.coalesce(F.lit(width).cast("int"), (F.size("sh_coeffs") / F.nullif(F.size("positions"), F.lit(0))).cast("int")).alias("_width")
    one = rows.select("scene_id", "sh_coeffs", each, F.posexplode(F.arrays_zip("positions", "opacities", "scales", "orientations")).alias("gaussian_id", "g"))
    terms = [F.get("g.positions", k).alias(c) for k, c in enumerate("xyz")] + [F.col("g.opacities").alias("opacity")] + [F.get("g.scales", k).alias(f"s{c}") for k, c in enumerate("xyz")] + [F.get("g.orientations", k).alias(f"q{c}") for k, c in enumerate("wxyz")]
    return one.select("scene_id", F.col("gaussian_id").cast("long").alias("gaussian_id"), *terms, F.slice("sh_coeffs", F.col("gaussian_id") * F.col("_width") + 1, F.col("_width")).alias("sh"))


def read_gaussian_ply(spark: SparkSession, path: str, rest: int = 0, pattern: str = "*.ply") -> DataFrame:
    """scene_id, gaussian_id, GAUSSIAN and sh of PLY exports of trained clouds, which many tasks read.

    Such files hold opacities before the logistic function, logarithms of scales, and coefficients f_dc_0..2 and f_rest_0.., of
    which rest are read. Orientations are normalised; one of length zero stays zero.
    """
    scales, turns = [f"scale_{k}" for k in range(3)], [f"rot_{k}" for k in range(4)]
    coefficients = [*[f"f_dc_{k}" for k in range(3)], *[f"f_rest_{k}" for k in range(rest)]]
    rows = read_ply(spark, path, ["x", "y", "z", "opacity", *scales, *turns, *coefficients], pattern)
    length = F.sqrt(sum(F.col(c) * F.col(c) for c in turns))
    found = [*[F.col(c) for c in "xyz"], 1 / (1 + F.exp(-F.col("opacity"))), *[F.exp(c) for c in scales], *[F.col(c) / F.when(length > 0, length).otherwise(1.0) for c in turns]]
    return rows.select("scene_id", F.col("point_id").alias("gaussian_id"), *[x.alias(c) for x, c in zip(found, GAUSSIAN, strict=True)], F.array(*coefficients).alias("sh"))


OBJECT = ("class_id", "lo_x", "lo_y", "lo_z", "hi_x", "hi_y", "hi_z")


def read_objects3d(spark: SparkSession, path: str, transforms: DataFrame | None = None) -> DataFrame:
    """scene_id, class_id, cx.., r0.., hx.., lo_x..hi_z of object tables; without a turned box it is the upright one.

    Objects in another frame than the capture's export (coord_frame) get their upright box through the scene's applied
    transform (transforms: scene_id, matrix), where it has one.
    """
    from vistaframe.functions import geometry as G
    from vistaframe.operators.transforms import OBB

    rows = spark.read.parquet(path)
    for c in OBB:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("double"))
    low, high = ([F.col(f"{n}_{c}") for c in "xyz"] for n in ("lo", "hi"))
    middle, half = [(a + b) / 2 for a, b in zip(low, high, strict=True)], [(b - a) / 2 for a, b in zip(low, high, strict=True)]
    eye = [F.lit(1.0 if k % 4 == 0 else 0.0) for k in range(9)]
    found = rows.select("scene_id", "coord_frame", *OBJECT, *[F.coalesce(c, x).alias(c) for c, x in zip(OBB, [*middle, *eye, *half], strict=True)])
    if transforms is None:
        return found.drop("coord_frame")
    m = F.col("_m")
    both = found.join(transforms.select("scene_id", F.col("matrix").alias("_m")), "scene_id", "left")
    a, b = G.transform_aabb(low, high, m)
    other = m.isNotNull() & (F.col("coord_frame") != "nerfstudio")
    new = dict(zip(OBB, [*[(x + y) / 2 for x, y in zip(a, b, strict=True)], *eye, *[(y - x) / 2 for x, y in zip(a, b, strict=True)]], strict=True)) | {f"lo_{c}": x for c, x in zip("xyz", a, strict=True)} | {f"hi_{c}": x for c, x in zip("xyz", b, strict=True)}
    return both.select(*[F.when(other, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in found.columns if c != "coord_frame"])


def write_objects3d(objects: DataFrame, path: str, coord_frame: str = "nerfstudio") -> None:
    objects.withColumn("coord_frame", F.lit(coord_frame)).write.mode("overwrite").parquet(path)
