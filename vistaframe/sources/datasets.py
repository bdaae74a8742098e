"""Detection datasets as folders: images and label text side by side by split, and a descriptor of their classes."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from vistaframe.sources.ply import located
from vistaframe.sources.tables import ship

SPLITS = ("train", "val")
#: Bytes of an image that are copied at once.
PIECE = 1 << 20


@dataclass
class Ended(WriterCommitMessage):
    files: int


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or of a URI with one slash or three, and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


class DatasetWriter(DataSourceArrowWriter):
    """Rows (split, label_key, value, image) as labels/<split>/<label_key>.txt and, with a path in image, images/<split>/<label_key> with that
    file's ending.

    A file's name and bytes follow from its row, and each appears at once by a rename in a hidden folder, so attempts that run twice
    do no harm. When all tasks have ended the hidden folders take the place of the old ones.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.classes = options["path"], json.loads(options["classes"])
        self.hidden = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Ended:
        files, root = opened(self.path)
        n = 0
        for batch in iterator:
            for split, key, value, image in zip(*(batch.column(c).to_pylist() for c in ("split", "label_key", "value", "image")), strict=True):
                if not re.fullmatch(r"[\w-]+", split or "") or not key or "/" in key:
                    raise ValueError(f"no file can be named by split {split!r} and label_key {key!r}")
                self.put(files, f"{root}/{self.hidden}/labels/{split}/{key}.txt", iter([value.encode()]))
                if image is not None:
                    self.put(files, f"{root}/{self.hidden}/images/{split}/{key}{self.ending(image)}", self.pieces(image))
                n += 1
        return Ended(n)

    @staticmethod
    def ending(image: str) -> str:
        name = image.rsplit("/", 1)[-1]
        return name[name.rindex(".") :] if "." in name[1:] else ""

    @staticmethod
    def pieces(image: str) -> Iterator[bytes]:
        source, at = opened(image)
        with source.open_input_stream(at) as stream:
            while data := stream.read(PIECE):
                yield data

    @staticmethod
    def put(files: fs.FileSystem, path: str, pieces: Iterator[bytes]) -> None:
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        fresh = f"{path}.{uuid.uuid4().hex}"
        with files.open_output_stream(fresh) as out:
            for piece in pieces:
                out.write(piece)
        files.move(fresh, path)

    def commit(self, messages: list[Ended | None]) -> None:
        files, root = opened(self.path)
        for kind in ("images", "labels"):
            for split in SPLITS:
                files.create_dir(f"{root}/{self.hidden}/{kind}/{split}", recursive=True)
            if files.get_file_info(f"{root}/{kind}").type == fs.FileType.Directory:
                files.delete_dir(f"{root}/{kind}")
            files.move(f"{root}/{self.hidden}/{kind}", f"{root}/{kind}")
        # JSON strings are YAML strings too, whatever a name holds.
        lines = [f"path: {json.dumps(root)}", *[f"{s}: images/{s}" for s in SPLITS], "names:" if self.classes else "names: {}", *[f"  {k}: {json.dumps(c)}" for k, c in enumerate(self.classes)], f"nc: {len(self.classes)}"]
        self.put(files, f"{root}/data.yaml", iter(["\n".join([*lines, ""]).encode()]))
        self.abort(messages)

    def abort(self, messages: list[Ended | None]) -> None:
        files, root = opened(self.path)
        if files.get_file_info(f"{root}/{self.hidden}").type == fs.FileType.Directory:
            files.delete_dir(f"{root}/{self.hidden}")


class DatasetFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return "detection_dataset"

    def schema(self) -> str:
        return "split string, label_key string, value string, image string"

    def writer(self, schema: StructType, overwrite: bool) -> DatasetWriter:
        return DatasetWriter(self.options)


def label_text(ordinal: Column) -> Column:
    """An image's label lines in order of ordinal, as one text; rows without a class are no line."""
    line = F.when(F.col("class_id").isNotNull(), F.struct(ordinal.alias("ordinal"), F.format_string("%d %.6f %.6f %.6f %.6f", "class_id", "xc", "yc", "w", "h").alias("line")))
    return F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: F.concat(x["line"], F.lit("\n"))), "")


def write_detection_dataset(rows: DataFrame, classes: list[str], path: str, images: DataFrame | None = None) -> None:
    """images/<split>/, labels/<split>/ and data.yaml under path, in place of what was there; train and val are always there.

    rows: split, label_key, ordinal, class_id (null for an image without labels, whose text is empty), xc, yc, w, h. images:
    label_key and path of the files to copy, of which a key's smallest counts; a key without one has labels only. Images are copied
    in pieces by the tasks. Keys that are empty, null or hold a slash are an error.
    """
    spark = rows.sparkSession
    ship(spark)
    spark.dataSource.register(DatasetFolder)
    texts = rows.groupBy("split", "label_key").agg(label_text(F.col("ordinal")).alias("value"))
    if images is None:
        found = texts.withColumn("image", F.lit(None).cast("string"))
    else:
        found = texts.join(images.groupBy("label_key").agg(F.min("path").alias("image")), "label_key", "left")
    ready = found.select("split", "label_key", "value", "image").repartition("split", "label_key")
    ready.write.format("detection_dataset").mode("append").option("classes", json.dumps(classes)).save(located(spark, path))
