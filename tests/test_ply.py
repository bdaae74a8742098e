"""Ranges of PLY bodies, files in pieces, and what a failed writer leaves."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaframe.sources import ply, sfm

HEADER = "ply\nformat {}\nelement vertex {}\nproperty float x\nproperty double y\nproperty float z\nproperty uchar red\nelement face 1\nproperty list uchar int vertex_indices\nend_header\n"


def cloud(n, order="<"):
    rows = np.zeros(n, [("x", order + "f4"), ("y", order + "f8"), ("z", order + "f4"), ("red", "u1")])
    rows["x"], rows["y"], rows["z"] = np.arange(n), np.arange(n) / 3, -1
    return rows


def test_a_long_file_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "s+1").mkdir()
    (tmp_path / "s+1" / "a.ply").write_bytes(HEADER.format("binary_little_endian 1.0", 1_000_000).encode() + cloud(1_000_000).tobytes() + b"\x03faces")
    rows = ply.read_ply(spark, str(tmp_path), ["y", "x"], range_bytes=1 << 20)
    assert rows.rdd.getNumPartitions() == 17
    n, low, high, distinct, wrong = rows.agg(F.count("*"), F.min("point_id"), F.max("point_id"), F.count_distinct("point_id"), F.count_if((F.col("x") != F.col("point_id")) | (F.abs(F.col("y") * 3 - F.col("x")) > 1e-6))).first()
    assert (n, low, high, distinct, wrong) == (1_000_000, 0, 999_999, 1_000_000, 0)
    assert [r[0] for r in rows.select("scene_id").distinct().collect()] == ["s+1"]


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_ranges_of_any_size_give_each_vertex_once(tmp_path, size):
    path = tmp_path / "s" / "a.ply"
    path.parent.mkdir()
    path.write_bytes(HEADER.format("binary_big_endian 1.0", 50).encode() + cloud(50, ">").tobytes())
    reader = ply.PlyReader({"path": f"file://{tmp_path}", "rangebytes": str(size)})
    batches = [b for part in reader.partitions() for b in reader.read(part)]
    assert [x for b in batches for x in b.column("point_id").to_pylist()] == list(range(50))
    assert [x for b in batches for x in b.column("x").to_pylist()] == list(range(50))


def test_short_files_share_a_task():
    tasks = ply.split([(f"f{k}", 10) for k in range(25)] + [("long", 250), ("none", 0)], 100)
    assert all(sum(end - start for *_, start, end in t.parts) <= 100 for t in tasks) and len(tasks) == 6
    assert sum(end - start for t in tasks for *_, start, end in t.parts) == 500


def test_files_that_are_empty_odd_or_cut(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    (folder / "none.ply").write_text(HEADER.format("ascii 1.0", 0))
    (folder / "_hidden.ply").write_text("no cloud")
    assert ply.read_ply(spark, str(tmp_path), ["x"]).count() == 0
    (folder / "text.ply").write_text(HEADER.format("ascii 1.0", 2) + "1 2 3 4\n\n5e-1 nan -inf 7\n3 0 1 2\n")
    rows = ply.read_ply(spark, str(tmp_path), ["z", "y", "x"]).orderBy("point_id").collect()
    assert [r["x"] for r in rows] == [1.0, 0.5] and math.isnan(rows[1]["y"]) and rows[1]["z"] == -math.inf
    for name, data, wrong in (("cut", HEADER.format("binary_little_endian 1.0", 9).encode() + cloud(8).tobytes(), "ends before"), ("text", b"hello", "no PLY header"), ("short", (HEADER.format("ascii 1.0", 2) + "1 2 3 4\n").encode(), "ends before"), ("list", b"ply\nformat ascii 1.0\nelement vertex 1\nproperty list uchar int x\nend_header\n", "a list among")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.ply").write_bytes(data)
        with pytest.raises(Exception, match=wrong):
            ply.read_ply(spark, str(tmp_path / name), ["x"]).count()
    with pytest.raises(Exception, match="no property alpha"):
        ply.read_ply(spark, str(folder), ["alpha"]).count()


def test_scenes_are_written_in_pieces_and_numbered_on(spark, tmp_path):
    points = spark.range(1000).selectExpr("if(id % 10 < 9, 'a b/ü+', 'small') AS scene_id", "1000 - id AS point_id", "cast(id AS double) AS x", "0.1D AS y", "if(id = 7, null, 2.0D) AS z")
    at = str(tmp_path / "out")
    ply.write_ply(points, at, file_points=100)
    assert len(list((tmp_path / "out").rglob("*.ply"))) == 10 and not list((tmp_path / "out").glob("_*"))
    rows = sfm.read_ply_points(spark, at).orderBy("scene_id", "point_id").collect()
    big = [r for r in rows if r["scene_id"] == "a b/ü+"]
    assert len(rows) == 1000 and [r["point_id"] for r in big] == list(range(900))
    assert [r["x"] for r in big] == [float(k) for k in range(999, -1, -1) if k % 10 < 9] and sum(math.isnan(r["z"]) for r in big) == 1
    first = min((tmp_path / "out").rglob("part-00003.ply")).read_bytes()
    assert first.startswith(b"ply\nformat binary_little_endian 1.0\n") and len(first.partition(b"end_header\n")[2]) == 1200
    # A writer that fails leaves what was there; one that ends replaces it; no points leave an empty folder.
    with pytest.raises(Exception, match="torn"):
        ply.write_ply(points.withColumn("x", F.when(F.col("point_id") == 500, F.raise_error(F.lit("torn"))).otherwise(F.col("x"))), at)
    assert sfm.read_ply_points(spark, at).count() == 1000
    ply.write_ply(points.where("scene_id = 'small'"), at)
    assert sfm.read_ply_points(spark, at).count() == 100
    ply.write_ply(points.limit(0), at)
    assert sfm.read_ply_points(spark, at).count() == 0


def test_gaussians_of_a_trained_cloud(spark, tmp_path):
    names = ["x", "y", "z", "f_dc_0", "f_dc_1", "f_dc_2", "f_rest_0", "opacity", "scale_0", "scale_1", "scale_2", "rot_0", "rot_1", "rot_2", "rot_3"]
    values = np.array([[1, 2, 3, 0.5, 0.25, 0.125, 9, 0, 0, math.log(2), 1, 3, 0, 4, 0], [0] * 15], "<f4")
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "cloud.ply").write_bytes(("ply\nformat binary_little_endian 1.0\nelement vertex 2\n" + "".join(f"property float {n}\n" for n in names) + "end_header\n").encode() + values.tobytes())
    one, zero = sfm.read_gaussian_ply(spark, str(tmp_path), rest=1).orderBy("gaussian_id").collect()
    assert np.allclose([one[c] for c in sfm.GAUSSIAN], [1, 2, 3, 0.5, 1, 2, math.e, 0.6, 0, 0.8, 0], atol=1e-6) and one["sh"] == [0.5, 0.25, 0.125, 9.0]
    assert [zero[c] for c in ("qw", "qx", "opacity", "sx")] == [0.0, 0.0, 0.5, 1.0]
