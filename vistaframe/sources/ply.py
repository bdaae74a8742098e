"""PLY clouds as a data source: byte ranges of fixed-width bodies are read by many tasks, and files are written by tasks and moved
into place when all have ended.

A scene is the folder its file lies in. Only listings and headers are looked at outside of tasks that read; no file is held whole.
"""

from __future__ import annotations

import fnmatch
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from vistaframe.operators.places import with_places
from vistaframe.sources.tables import ship

#: Fixed values of the format: scalar types by both of their names, and byte orders.
KINDS = {"char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "i2", "int16": "i2", "ushort": "u2", "uint16": "u2", "int": "i4", "int32": "i4", "uint": "u4", "uint32": "u4", "float": "f4", "float32": "f4", "double": "f8", "float64": "f8"}
ORDERS = {"binary_little_endian": "<", "binary_big_endian": ">", "ascii": ""}

#: Bytes of a task's ranges; rows of a batch; the longest header; points of a file that is written.
RANGE_BYTES, BATCH_ROWS, HEADER_BYTES, FILE_POINTS = 32 << 20, 1 << 16, 1 << 20, 1 << 24
#: Names the place in the scene of a file's first point, so that a scene may be several files.
FIRST = "comment first_point"


@dataclass
class Header:
    order: str
    count: int
    fields: list[tuple[str, str]]
    first: int
    starts: int  # where the vertices' bytes begin

    @property
    def row(self) -> np.dtype:
        return np.dtype([(name, self.order + kind) for name, kind in self.fields])


def parse_header(data: bytes, name: str = "") -> Header:
    """A file's header. Vertices must be the first element and have scalar properties only; others after them are not read."""
    found = re.search(rb"end_header\r?\n", data)
    if not data.startswith(b"ply") or not found:
        raise ValueError(f"{name} has no PLY header")
    order, count, fields, first, elements = None, 0, [], 0, []
    for line in data[: found.start()].decode("ascii", "replace").splitlines():
        words = line.split()
        if line.startswith(FIRST):
            first = int(words[2])
        elif words[:1] == ["format"]:
            order = ORDERS[words[1]]
        elif words[:1] == ["element"]:
            elements.append(words[1])
            if words[1] == "vertex":
                count = int(words[2])
        elif words[:1] == ["property"] and elements[-1:] == ["vertex"]:
            if words[1] == "list":
                raise ValueError(f"{name} has a list among the properties of its vertices")
            fields.append((words[2], KINDS[words[1]]))
    if order is None or elements[:1] != ["vertex"]:
        raise ValueError(f"{name} doesn't begin with vertices")
    return Header(order, count, fields, first, found.end())


@dataclass
class Ranges(InputPartition):
    """(path, size of the file, start, end) of the byte ranges of one task."""

    parts: list[tuple[str, int, int, int]]


def split(files: list[tuple[str, int]], size: int) -> list[Ranges]:
    """The files' bytes as tasks of about size bytes: long files are cut, short ones share a task."""
    tasks, held, total = [], [], 0
    for path, length in sorted(files):
        for start in range(0, max(length, 1), size):
            end = min(start + size, length)
            if held and total + end - start > size:
                tasks.append(Ranges(held))
                held, total = [], 0
            held.append((path, length, start, end))
            total += end - start
    return [*tasks, Ranges(held)] if held else tasks


def scene_name(path: str) -> str:
    folder = path.rstrip("/").split("/")[-2:-1]
    return unquote(folder[0].removeprefix("scene_id=")) if folder else ""


class PlyReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.pattern = options["path"], options.get("pattern", "*.ply")
        self.size = int(options.get("rangebytes", RANGE_BYTES))
        self.properties = options.get("properties", "x,y,z").split(",")

    def partitions(self) -> list[Ranges]:
        files, root = fs.FileSystem.from_uri(self.path)
        info = files.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        listed = [info] if info.is_file else files.get_file_info(fs.FileSelector(root, recursive=True))
        hidden = lambda p: any(x[:1] in "._" for x in p.removeprefix(root).strip("/").split("/") if x)
        return split([(f.path, f.size) for f in listed if f.is_file and fnmatch.fnmatch(f.base_name, self.pattern) and not hidden(f.path)], self.size) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(self.path)
        for path, length, start, end in partition.parts:
            with files.open_input_file(path) as file:
                data = b""
                while b"end_header" not in data[:-2] and len(data) < min(length, HEADER_BYTES):
                    data += file.read(4096)
                header = parse_header(data, path)
                missing = [c for c in self.properties if c not in dict(header.fields)]
                if missing:
                    raise ValueError(f"{path} has no property {missing[0]}")
                if header.order == "":
                    # Lines have no fixed width, so the task of a file's beginning reads all of them, batch by batch.
                    yield from self.ascii(files, path, header) if start == 0 else ()
                else:
                    yield from self.binary(file, path, length, start, end, header)

    def binary(self, file: pa.NativeFile, path: str, length: int, start: int, end: int, header: Header) -> Iterator[pa.RecordBatch]:
        """The vertices that begin in bytes start to end."""
        width = header.row.itemsize
        if header.starts + width * header.count > length:
            raise ValueError(f"{path} ends before its {header.count} vertices do")
        at, stop = (min(header.count, max(0, -(-(x - header.starts) // width))) for x in (start, end))
        file.seek(header.starts + at * width)
        while at < stop:
            n = min(BATCH_ROWS, stop - at)
            rows = np.frombuffer(file.read(n * width), header.row)
            yield self.batch(path, header.first + at, [rows[c] for c in self.properties])
            at += n

    def ascii(self, files: fs.FileSystem, path: str, header: Header) -> Iterator[pa.RecordBatch]:
        places = [[name for name, _ in header.fields].index(c) for c in self.properties]
        at, rest = 0, b""
        with files.open_input_stream(path) as stream:
            stream.read(header.starts)
            while at < header.count:
                data = stream.read(1 << 20)
                *lines, rest = (rest + data).split(b"\n") if data else [rest, b""]
                rows = [words for words in map(bytes.split, lines) if words][: header.count - at]
                if rows:
                    numbers = np.array([[float(words[k]) for k in places] for words in rows])
                    yield self.batch(path, header.first + at, list(numbers.T))
                    at += len(rows)
                if not data and at < header.count:
                    raise ValueError(f"{path} ends before its {header.count} vertices do")

    def batch(self, path: str, first: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        n = len(columns[0])
        named = {"scene_id": pa.array([scene_name(path)]).take(pa.array(np.zeros(n, np.int32))), "point_id": pa.array(np.arange(first, first + n))}
        return pa.RecordBatch.from_pydict(named | {c: pa.array(np.asarray(x, np.float64)) for c, x in zip(self.properties, columns, strict=True)})


@dataclass
class Moved(WriterCommitMessage):
    """Where an ended task's files lie, and where they belong."""

    files: list[tuple[str, str]] = field(default_factory=list)


class PlyWriter(DataSourceArrowWriter):
    """Rows (scene_id, _piece, _first, _n, x, y, z), those of a piece together and in order, as a little-endian file for each piece.

    Tasks write under a hidden folder, each attempt under its own name; when all have ended, what path held goes (with overwrite) and
    the files of the attempts that count are moved. So a job whose tasks fail leaves the old files.
    """

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.overwrite = options["path"], overwrite
        self.hidden = f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Moved:
        files, root = fs.FileSystem.from_uri(self.path)
        attempt = f"{root}/{self.hidden}/{uuid.uuid4().hex}"
        files.create_dir(attempt, recursive=True)
        done, key, out, left = Moved(), None, None, 0
        for batch in iterator:
            scenes, pieces, firsts, counts = (batch.column(c).to_pylist() for c in ("scene_id", "_piece", "_first", "_n"))
            body = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in "xyz"], axis=1).astype("<f4")
            keys = list(zip(scenes, pieces, strict=True))
            edges = [0, *[k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], len(keys)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if keys[a] != key:
                    self.close(out, left, key)
                    key, left = keys[a], counts[a]
                    done.files.append((f"{attempt}/{len(done.files)}", f"{root}/scene_id={folder(key[0])}/part-{key[1]:05d}.ply"))
                    out = files.open_output_stream(done.files[-1][0])
                    out.write("\n".join(["ply", "format binary_little_endian 1.0", f"{FIRST} {firsts[a]}", f"element vertex {left}", *[f"property float {c}" for c in "xyz"], "end_header", ""]).encode())
                out.write(body[a:b].tobytes())
                left -= b - a
        self.close(out, left, key)
        return done

    @staticmethod
    def close(out: pa.NativeFile | None, left: int, key: tuple | None) -> None:
        if out is not None:
            out.close()
        if left:
            raise ValueError(f"{left} points of {key} came apart from the others")

    def commit(self, messages: list[Moved | None]) -> None:
        files, root = fs.FileSystem.from_uri(self.path)
        files.create_dir(root, recursive=True)
        if self.overwrite:
            for old in files.get_file_info(fs.FileSelector(root)):
                if old.base_name != self.hidden:
                    (files.delete_file if old.is_file else files.delete_dir)(old.path)
        for source, target in [pair for m in messages if m for pair in m.files]:
            files.create_dir(target.rsplit("/", 1)[0], recursive=True)
            files.move(source, target)
        self.abort(messages)

    def abort(self, messages: list[Moved | None]) -> None:
        files, root = fs.FileSystem.from_uri(self.path)
        if files.get_file_info(f"{root}/{self.hidden}").type == fs.FileType.Directory:
            files.delete_dir(f"{root}/{self.hidden}")


def folder(scene: str | None) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if scene is None else quote(scene, safe=" ")


class PlySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ply_points"

    def schema(self) -> str:
        return "scene_id string, point_id long, " + ", ".join(f"`{c}` double" for c in self.options.get("properties", "x,y,z").split(","))

    def reader(self, schema: StructType) -> PlyReader:
        return PlyReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> PlyWriter:
        return PlyWriter(self.options, overwrite)


def located(spark: SparkSession, path: str) -> str:
    """path with its file system, as Spark would find it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return re.sub(r"^file:/+", "file:///", at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString())


def read_ply(spark: SparkSession, path: str, properties: list[str], pattern: str = "*.ply", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """scene_id, point_id and properties as doubles of the vertices of the PLY files under path: ASCII, or binary of either byte order.

    Files whose name or folder begins with "_" or "." are left out. A binary file is cut into ranges of about range_bytes, a task
    each; an ASCII file is one task, in batches. point_id is the place in the file, after the first_point of its header. A file
    without vertices gives no row; one that lacks a property, ends early or is no PLY is an error.
    """
    ship(spark)
    spark.dataSource.register(PlySource)
    return spark.read.format("ply_points").option("pattern", pattern).option("properties", ",".join(properties)).option("rangebytes", str(range_bytes)).load(located(spark, path))


def write_ply(points: DataFrame, path: str, file_points: int = FILE_POINTS) -> None:
    """Float x, y, z of points as little-endian PLY under path/scene_id=.../part-*.ply, in order of point_id, in place of what was there.

    A scene of more than file_points points is several files, each whole by itself, so a large scene is many tasks; read_ply()
    numbers its points on from file to file. Ids themselves aren't kept. Coordinates that are null are written as NaN.
    """
    ship(points.sparkSession)
    points.sparkSession.dataSource.register(PlySource)
    known = points.select("scene_id", "point_id", *[F.coalesce(F.col(c).cast("float"), F.lit(float("nan"))).alias(c) for c in "xyz"])
    placed = with_places(known, "scene_id", ["point_id"], "_at", "_total").withColumn("_piece", F.floor(F.col("_at") / file_points))
    first = F.col("_piece") * file_points
    pieces = placed.select("scene_id", "_piece", first.alias("_first"), F.least(F.lit(file_points), F.col("_total") - first).alias("_n"), *"xyz", "_at")
    ordered = pieces.repartition("scene_id", "_piece").sortWithinPartitions("scene_id", "_piece", "_at").drop("_at")
    ordered.write.format("ply_points").mode("overwrite").save(located(points.sparkSession, path))
