"""Manifests, tracks and transforms round trips; images, poses and principal boxes."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaframe.operators import images, poses
from vistaframe.sources import manifests, sfm, versions

EYE = [[1.0, 0, 0, 0], [0, 1.0, 0, 0], [0, 0, 1.0, 0], [0, 0, 0, 1.0]]


def scene(folder, name, document):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(document))


def test_manifest_round_trip(spark, tmp_path):
    document = {
        "scene_name": "room", "build_mode": "production", "review_state": "pending", "scale": {"method": "anchor", "meters_per_unit": 0.3, "confidence": 0.9, "approved": True},
        "captures": [{"capture_id": "c1", "modality": "rgb", "path": "p"}], "transforms": [{"source_frame": "a", "target_frame": "b", "matrix": EYE, "confidence": 1.0, "evidence": "e"}],
        "objects": [{"instance_id": f"o{k}", "class_name": "chair", "movable": True, "review_state": "approved", "observed_background_coverage": 0.5, "physics": {"mass_kg": "1"}} for k in (2, 1)],
        "artifacts": [{"artifact_id": "x", "path": "y", "metadata": {"transform_hash": "h"}}], "approvals": {"scale": {"state": "approved", "reviewer": "me", "notes": "", "timestamp": "t"}},
    }
    scene(tmp_path / "in" / "s1", "manifest.json", document)
    tables = manifests.read_manifest(spark, str(tmp_path / "in"))
    assert [r["instance_id"] for r in tables["objects"].orderBy("ordinal").collect()] == ["o2", "o1"]
    manifests.write_manifest(tables, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("version-*/scene_id=s1/part-*.json")
    assert json.loads(part.read_text()) == document
    scene(tmp_path / "bad" / "s1", "manifest.json", {"objects": 3})
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        manifests.read_manifest(spark, str(tmp_path / "bad"))["objects"].collect()


def test_a_killed_writer_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "reports")
    rows = spark.createDataFrame([("s1", 1), ("s2", 2)], "scene_id string, n long")
    read = lambda: sorted((r["scene_id"], r["n"]) for r in sfm.read_reports(spark, path, "n long").collect())
    sfm.write_reports(rows, path)
    broken = rows.withColumn("n", F.when(F.col("scene_id") == "s2", F.raise_error(F.lit("killed")).cast("long")).otherwise(9))
    with pytest.raises(Exception, match="killed"):
        sfm.write_reports(broken, path)
    assert read() == [("s1", 1), ("s2", 2)]
    # A table may be written over the one it was read from.
    sfm.write_reports(sfm.read_reports(spark, path, "n long").withColumn("n", F.col("n") * 10), path)
    assert read() == [("s1", 10), ("s2", 20)]
    folder = versions.Folder(spark, path)
    assert folder.number() == 1 and len(list((tmp_path / "reports").glob("version-*"))) == 3
    folder.drop_old(0)
    assert len(list((tmp_path / "reports").glob("version-*"))) == 1 and read() == [("s1", 10), ("s2", 20)]
    with pytest.raises(FileNotFoundError):
        versions.Folder(spark, str(tmp_path / "none")).latest()


def test_upsert_replaces_rows_by_key_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(r, "k string, v int")
    versions.upsert(rows(("a", 1), (None, 2)), path, ["k"], 0)
    versions.upsert(rows((None, 3), ("b", 4)), path, ["k"], 1)
    versions.upsert(rows(("a", 99)), path, ["k"], 1)  # the same batch again
    got = spark.read.parquet(versions.Folder(spark, path).latest()).collect()
    assert sorted(map(tuple, got), key=str) == [("a", 1), ("b", 4), (None, 3)]


def test_tracks_and_transforms(spark, tmp_path):
    detection = lambda k: {"frame": f"f{k}", "class_name": "chair", "confidence": 0.5, "xyxy": [0.0, 1.0, 2.0, float(k)], "source": "d"}
    document = {"instances": [{"instance_id": "chair_001", "class_name": "chair", "confidence": 0.5, "detections": [detection(2), detection(1)]}]}
    scene(tmp_path / "t" / "s1", "instances.json", document)
    rows = manifests.read_tracks(spark, str(tmp_path / "t"))
    assert [(r["frame"], r["y1"]) for r in rows.orderBy("ordinal").collect()] == [("f2", 2.0), ("f1", 1.0)]
    manifests.write_tracks(rows, str(tmp_path / "o"))
    (part,) = (tmp_path / "o").glob("version-*/scene_id=s1/part-*.json")
    assert json.loads(part.read_text()) == document
    scene(tmp_path / "m" / "s1", "transform.json", {"colmap_to_usd": EYE})
    assert manifests.read_transform(spark, str(tmp_path / "m")).first()["matrix"] == [x for r in EYE for x in r]
    scene(tmp_path / "n" / "s1", "transform.json", {"matrix": [[1, 0, 0, 0], [0, 2, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]]})
    with pytest.raises(Exception, match="no similarity"):
        manifests.read_transform(spark, str(tmp_path / "n")).collect()


def test_similarity_of_images(spark):
    random = np.random.default_rng(0)
    a = random.integers(0, 256, (24, 30, 3), dtype=np.uint8)
    b = np.clip(a.astype(int) + random.integers(-60, 60, a.shape), 0, 255).astype(np.uint8)
    schema = "name string, height int, width int, data binary"
    one = spark.createDataFrame([("x", 24, 30, bytes(a.tobytes())), ("y", 24, 30, bytes(a.tobytes())), ("z", 24, 30, bytes(a.tobytes()))], schema)
    two = spark.createDataFrame([("x", 24, 30, bytes(a.tobytes())), ("y", 24, 30, bytes(b.tobytes())), ("z", 48, 60, bytes(np.repeat(np.repeat(a, 2, 0), 2, 1).tobytes()))], schema)
    got = {r["name"]: (r["psnr"], r["ssim"]) for r in images.view_metrics(one, two, ["name"]).collect()}
    assert got["x"] == (np.inf, pytest.approx(1.0)) and got["y"][1] < 0.95 and 10 < got["y"][0] < 25
    assert got["z"][1] > 0.999
    sharp = {r["name"]: r["sharpness"] for r in images.sharpness(spark.createDataFrame([("flat", 9, 9, bytes(243)), ("noise", 24, 30, bytes(a.tobytes()))], schema), ["name"]).collect()}
    assert sharp["flat"] == 0 and sharp["noise"] > 1000


def test_path_through_poses(spark):
    half = float(np.sqrt(0.5))
    rows = [("s", "a", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), ("s", "b", half, 0.0, 0.0, half, 2.0, 0.0, 0.0), ("one", "a", 1.0, 0.0, 0.0, 0.0, 9.0, 0.0, 0.0)]
    known = spark.createDataFrame(rows, "scene_id string, name string, qw double, qx double, qy double, qz double, px double, py double, pz double")
    alphas = spark.createDataFrame([("s", 0.0), ("s", 0.5), ("s", 7.0)], "scene_id string, alpha double")
    got = {r["alpha"]: r for r in poses.interpolate_poses(known, alphas, "name").collect()}
    assert got[0.0]["qw"] == pytest.approx(1) and got[7.0]["px"] == 2.0
    assert got[0.5]["px"] == 1.0 and got[0.5]["qz"] == pytest.approx(np.sin(np.pi / 8))
    novel = poses.sample_novel_poses(known, 5, "name", 0.01, seed=3)
    assert {(r["scene_id"], r["ordinal"]) for r in novel.collect()} == {("s", k) for k in range(5)} | {("one", 0)}
    key = lambda r: (r["scene_id"], r["ordinal"])
    assert sorted(novel.collect(), key=key) == sorted(poses.sample_novel_poses(known.repartition(3), 5, "name", 0.01, seed=3).collect(), key=key)


def test_box_along_principal_axes(spark):
    random = np.random.default_rng(1)
    local = random.uniform(-1, 1, (3000, 3)) * [4, 2, 0.5]
    turn = np.array([[0.6, -0.8, 0], [0.8, 0.6, 0], [0, 0, 1.0]])
    cloud = local @ turn.T + [1, 2, 3]
    df = spark.createDataFrame([("s", *map(float, p)) for p in cloud] + [("few", 0.0, 0.0, 0.0)], "scene_id string, x double, y double, z double")
    found = {r["scene_id"]: r for r in poses.fit_obb_pca(df, ["scene_id"]).collect()}
    assert [found["s"][f"half{k}"] for k in range(3)] == pytest.approx([3.6, 1.8, 0.45], abs=0.1)
    assert abs(found["s"]["a0x"] * 0.6 + found["s"]["a0y"] * 0.8) > 0.999
    assert [found["few"][f"half{k}"] for k in range(3)] == [1e-3] * 3
