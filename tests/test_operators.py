"""Closed forms, properties and replays of the scene operators."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaframe.functions import geometry as G
from vistaframe.functions import names as N
from vistaframe.operators import boxes, cloud, dataset, frames, meshes, quality, quantiles, spatial, tracks
from vistaframe.operators import cameras as C
from vistaframe.sources import sfm
from vistaframe.sources.fixtures import view
from vistaframe.sources.versions import Folder, upsert
from vistaframe.streaming import streams

SF = "/root/testdata/sf0.001"
POSE = "scene_id string, image_id long, camera_id int, qw double, qx double, qy double, qz double, tx double, ty double, tz double"
CAMERA = "scene_id string, camera_id int, model string, width int, height int, fx double, fy double, cx double, cy double"
POINT = "scene_id string, point_id long, x double, y double, z double"


def test_view_counts_of_two_cameras(spark):
    cameras = spark.createDataFrame([("a", 1, "PINHOLE", 100, 100, 50.0, 50.0, 50.0, 50.0)], CAMERA)
    images = spark.createDataFrame([("a", 1, 1, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), ("a", 2, 1, 1.0, 0.0, 0.0, 0.0, 0.2, 0.0, 0.0), ("a", 3, 9, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)], POSE)
    points = spark.createDataFrame([("a", 0, 0.0, 0.0, 2.0), ("a", 1, 0.0, 0.0, -1.0), ("a", 2, 50.0, 0.0, 1.0)], POINT)
    assert {r["point_id"]: r["views"] for r in C.view_counts(points, images, cameras).collect()} == {0: 2, 1: 0, 2: 0}
    with pytest.raises(Exception, match="no camera 9"):
        C.poses_with_cameras(images, cameras, strict=True).collect()


def test_scores_of_known_views(spark):
    rows = spark.createDataFrame([(1.0, 40.0, 0.0, None, 0), (1.0, 0.0, None, None, 0), (None, None, 0.1, None, 0), (1.0, 40.0, 0.0, 3.0, 5)], "s double, p double, l double, r double, f int")
    score = quality.quality_score(F.col("s"), F.col("p"), F.col("l"), F.col("r"), 1.0, F.col("f"))
    assert [tuple(r) for r in rows.select(*score).collect()] == [(100.0, 100.0), (80.0, 80.0), (None, None), (100.0, 65.0)]


def test_outliers_and_opacity_of_a_small_cloud(spark):
    rnd = np.random.default_rng(0)
    core = rnd.normal(0, 0.1, (200, 3))
    far = np.array([[50.0, 0, 0], [0, 60.0, 0], [0, 0, 70.0]])
    rows = [("a", k, *map(float, p), 0.5 if k else 0.01, 0.1, 0.1, 0.1) for k, p in enumerate(np.concatenate([core, far]))]
    g = spark.createDataFrame(rows, "scene_id string, gaussian_id long, x double, y double, z double, opacity double, sx double, sy double, sz double")
    cleaned = cloud.clean_gaussians(g, outlier_std=5.0, min_opacity=0.05)
    reasons = {r["gaussian_id"]: r["reason"] for r in cleaned.collect()}
    assert reasons[0] == "opacity" and [reasons[200 + k] for k in range(3)] == ["outlier"] * 3
    report = cloud.cleanup_report(cleaned).first()
    assert report["input"] == 203 and report["kept"] >= 180
    assert report["input"] - report["kept"] == sum(report[f"removed_{r}"] for r in cloud.RULES)


def test_radius_and_nearest_equal_brute_force(spark):
    rnd = random.Random(4)
    pts = [("a", k, *(rnd.uniform(-2, 2) for _ in range(3))) for k in range(150)] + [("b", 1000, 0.0, 0.0, 0.0), ("a", 999, 300.0, 0.0, 0.0)]
    df = spark.createDataFrame(pts, "scene_id string, id long, x double, y double, z double")
    near = {(i[1], j[1]) for i in pts for j in pts if i[0] == j[0] and math.dist(i[2:], j[2:]) <= 0.7}
    assert {(r["a_id"], r["b_id"]) for r in spatial.radius_join(df, df, 0.7).collect()} == near
    odd = df.where("id % 2 = 1")
    found = {r["a_id"]: r["b_id"] for r in spatial.nearest_join(df.where("id % 2 = 0"), odd, 0.1).collect()}
    for p in pts:
        if p[1] % 2 == 0 and p[0] == "a":
            assert found[p[1]] == min((q for q in pts if q[0] == "a" and q[1] % 2), key=lambda q: (math.dist(p[2:], q[2:]), q[1]))[1]
    assert 1000 not in found


def test_rotations_go_round(spark):
    rnd = np.random.default_rng(1)
    q = rnd.normal(size=(50, 4))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    df = spark.createDataFrame([tuple(map(float, r)) for r in q], "qw double, qx double, qy double, qz double")
    back = np.array([tuple(r) for r in df.select(*G.rotmat_to_quat(G.quat_to_rotmat(C.quaternion()))).collect()])
    assert np.allclose(np.abs((back * q).sum(axis=1)), 1, atol=1e-9)
    n = df.select(*[F.col(c) / F.sqrt(F.col("qx") ** 2 + F.col("qy") ** 2 + F.col("qz") ** 2) for c in ("qx", "qy", "qz")]).toDF("x", "y", "z")
    up = n.select(*G.rotate(G.rotation_to_up(C.xyz()), C.xyz())).collect()
    assert all(abs(r[0]) < 1e-9 and abs(r[1]) < 1e-9 and abs(r[2] - 1) < 1e-9 for r in up)


def test_floor_of_a_room(spark):
    rnd = np.random.default_rng(2)
    floor = np.c_[rnd.uniform(-2, 2, (400, 2)), rnd.normal(0, 0.005, 400)]
    clutter = np.c_[rnd.uniform(-2, 2, (200, 2)), rnd.uniform(0, 2, 200)]
    points = spark.createDataFrame([("a", k, *map(float, p)) for k, p in enumerate(np.concatenate([floor, clutter]))] + [("few", 1, 0.0, 0.0, 0.0)], POINT)
    ups = spark.createDataFrame([("a", 0.0, 0.0, 1.0), ("few", 0.0, 0.0, 1.0)], "scene_id string, x double, y double, z double")
    found = frames.fit_floor(points, ups).collect()
    assert [r["scene_id"] for r in found] == ["a"]
    assert found[0]["nz"] > 0.999 and abs(found[0]["offset"]) < 0.03 and found[0]["ratio"] > 0.6
    again = frames.fit_floor(points.repartition(13), ups).collect()
    assert again == found


def test_floor_is_refined_by_all_its_inliers(spark):
    rnd = np.random.default_rng(4)
    low = np.c_[rnd.uniform(-2, 2, (3000, 2)), np.zeros(3000)]
    low[:, 2] = 0.1 * low[:, 0] - 0.2 * low[:, 1] + rnd.normal(0, 0.004, 3000) - 100.0
    points = spark.createDataFrame([("a", k, *map(float, p)) for k, p in enumerate(low)], POINT)
    ups = spark.createDataFrame([("a", 0.0, 0.0, 1.0)], "scene_id string, x double, y double, z double")
    (found,) = frames.fit_floor(points, ups).collect()
    normal = np.linalg.svd(low - low.mean(axis=0), full_matrices=False)[2][-1]
    normal *= np.sign(normal[2])
    assert found["inliers"] == 3000 and found["ratio"] == 1.0
    assert np.allclose([found["nx"], found["ny"], found["nz"]], normal, atol=1e-9)
    assert abs(found["offset"] - np.median(low @ normal)) < 1e-7
    assert frames.fit_floor(points.repartition(13), ups).collect() == [found]


def test_paths_of_a_long_chain(spark):
    step = [1.0, 0.0, 0.0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    rows = [("long", k, k, k + 1, step) for k in range(11)] + [("ring", k, k, (k + 1) % 5, step) for k in range(5)]
    edges = spark.createDataFrame(rows, "scene_id string, ordinal long, source long, target long, matrix array<double>")
    got = {(r["scene_id"], r["source"], r["target"]): (r["hops"], r["matrix"][3]) for r in frames.frame_paths(edges).collect()}
    chain = {("long", a, b): (abs(a - b), float(b - a)) for a in range(12) for b in range(12)}
    assert {k: v for k, v in got.items() if k[0] == "long"} == chain
    ring = {("ring", a, b): min(abs(a - b), 5 - abs(a - b)) for a in range(5) for b in range(5)}
    assert {k: v[0] for k, v in got.items() if k[0] == "ring"} == ring


def test_split_does_not_depend_on_partitions(spark):
    f = view(spark, SF, "frames")
    one = {r["frame_id"]: r["split"] for r in dataset.assign_split(f.repartition(1), seed=3).collect()}
    many = {r["frame_id"]: r["split"] for r in dataset.assign_split(f.repartition(17), seed=3).collect()}
    assert one == many and set(one.values()) == {"train", "val"}
    alone = dataset.assign_split(f.where("session = 'src1'"), ratio=0.5, seed=3)
    assert {r["split"] for r in alone.collect()} == {"train", "val"}


def test_names(spark):
    rows = spark.createDataFrame([("./s1/frame_0012.JPG",), ("a__b_7.png",), ("!!",)], "p string")
    got = rows.select(N.frame_label_key(F.col("p")), N.frame_index(N.stem(F.col("p"))), N.frame_sort_key(F.col("p")), N.session_of(F.col("p")), N.class_slug(F.col("p")), N.supported_video(F.lit("x.MP4"))).collect()
    assert [tuple(r) for r in got] == [("s1_frame_0012", 12, 1, "./s1", "s1_frame_0012_jpg", True), ("a__b_7", None, 7, "a", "a_b_7_png", True), ("!!", None, 0, "default", "object", True)]


def test_greedy_association(spark):
    box = lambda x: (x, 0.0, x + 10.0, 10.0)
    rows = [("s", 0, "f1", "chair", 0.9, *box(0.0)), ("s", 1, "f2", "chair", 0.9, *box(1.0)), ("s", 2, "f2", "chair", 0.5, *box(100.0)), ("s", 3, "f3", "lamp", 0.5, *box(0.0)), ("s", 4, "f4", "lamp", 0.5, *box(0.0)), ("s", 5, "f5", "chair", 0.5, *box(2.0)), ("s", 6, "f5", "chair", 0.9, *box(100.0))]
    d = spark.createDataFrame(rows, "scene_id string, ordinal long, frame string, class_name string, confidence double, x0 double, y0 double, x1 double, y1 double")
    assert {r["ordinal"]: r["track"] for r in tracks.associate_detections(d).collect()} == {0: 1, 1: 1, 2: 2, 3: 1, 4: 1, 5: 4, 6: 3}


def test_sessions_give_the_tracks_of_one_pass(spark):
    """A class seen now and then is many sessions; numbers are those of one pass over all its frames."""
    rnd = random.Random(8)
    rows, at = [], 0
    for frame in range(400):
        rows.append(("s", at, f"f{frame:04}", "every", 0.5, 0.0, 0.0, 1.0, 1.0))  # makes every frame ranked
        at += 1
        if frame % 9 < 4:
            for _ in range(rnd.randrange(1, 4)):
                x = rnd.choice([0.0, 4.0, 30.0]) + rnd.random() * 4
                rows.append(("s", at, f"f{frame:04}", rnd.choice(["chair", None]), rnd.random(), x, 0.0, x + 10, 10.0))
                at += 1
    d = spark.createDataFrame(rows, "scene_id string, ordinal long, frame string, class_name string, confidence double, x0 double, y0 double, x1 double, y1 double").repartition(6)
    want = {}
    for name in ("every", "chair", None):
        matcher = tracks.Matcher()
        for frame in range(400):
            mine = [r for r in rows if r[3] == name and r[2] == f"f{frame:04}"]
            want |= dict(zip([r[1] for r in mine], matcher.frame(frame + 1, [(r[4], r[5:]) for r in mine]), strict=True)) if mine else {}
    assert {r["ordinal"]: r["track"] for r in tracks.associate_detections(d).collect()} == want
    assert tracks.sessions(tracks.frame_rank(d)).where("class_name = 'chair'").select("session").distinct().count() > 30


OBSERVED = "scene_id string, class_id int, ordinal long, cx double, cy double, cz double, ox double, oy double, oz double, gx double, gy double, gz double, points array<struct<x: double, y: double, z: double>>"


def test_merge_takes_the_first_near_object(spark):
    rows = [("s", 1, k, x, 0.0, 0.0, 0.0, -3.0, 0.0, 0.0, 0.0, 1.0, [(x, 0.0, 0.0)]) for k, x in enumerate([0.0, 0.5, 0.3, 5.0])]
    d = spark.createDataFrame(rows, OBSERVED)
    assert {r["ordinal"]: r["merged"] for r in boxes.merge_objects(d, 0.35).collect()} == {0: 0, 1: 1, 2: 0, 3: 2}


def test_merging_fits_again_on_all_points(spark):
    """Against a plain list of objects: centres move as objects grow, so members depend on the fits."""
    rnd = np.random.default_rng(4)
    up, rows, want = np.array([0.0, 0.0, 1.0]), [], {}
    objects: dict[tuple, list] = {}
    for k in range(120):
        scene, kind = f"s{k % 2}", k % 3
        points = rnd.normal(rnd.integers(0, 3, 3) * 0.8, [0.5, 0.2, 0.1], (rnd.integers(1, 30), 3))
        origin = rnd.normal(0, 4, 3)
        centre = boxes.view_centre(points, origin, up, 5.0)
        rows.append((scene, kind, k, *centre.tolist(), *origin.tolist(), *up.tolist(), [tuple(p) for p in points.tolist()]))
        held = objects.setdefault((scene, kind), [])
        for j, (c, o, p) in enumerate(held):
            if np.linalg.norm(c - centre) <= 0.7:
                both, seen = np.concatenate([p, points]), (o * len(p) + origin * len(points)) / (len(p) + len(points))
                held[j] = (boxes.view_centre(both, seen, up, 5.0), seen, both)
                want[k] = j
                break
        else:
            want[k] = len(held)
            held.append((centre, origin, points))
    got = {r["ordinal"]: r["merged"] for r in boxes.merge_objects(spark.createDataFrame(rows[::-1], OBSERVED), 0.7).collect()}
    assert got == want and max(want.values()) > 3 and len(want) > 2 * sum(len(o) for o in objects.values()) / 2


def test_fitted_box_follows_the_view(spark):
    rnd = np.random.default_rng(5)
    turn = np.array([[0.6, -0.8, 0.0], [0.8, 0.6, 0.0], [0.0, 0.0, 1.0]])
    points = (rnd.uniform(-1, 1, (4000, 3)) * [2.0, 0.5, 0.25]) @ turn.T + [3.0, 4.0, 1.0]
    rows = [("a", *p, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0) for p in points.tolist()] + [("b", 1.0, 2.0, 3.0, 1.0, 2.0, 0.0, 0.0, 0.0, 1.0)]
    d = spark.createDataFrame(rows, "k string, x double, y double, z double, ox double, oy double, oz double, gx double, gy double, gz double")
    got = {r["k"]: r for r in boxes.fit_obb_view(d, ["k"]).collect()}
    a, b = got["a"], got["b"]
    assert all(abs(a[c] - v) < 0.05 for c, v in (("cx", 3), ("cy", 4), ("cz", 1), ("half_f", 1.8), ("half_r", 0.45), ("half_u", 0.225), ("fx", 0.6), ("fy", 0.8)))
    # Seen from straight below: x turned about up.
    assert (b["fx"], b["fy"], b["fz"], b["half_f"], b["points"]) == (0.0, 1.0, 0.0, 1e-3, 1)
    few = boxes.fit_obb_view(d, ["k"], max_extent=1.0, light=100).where("k = 'a'").first()
    assert few["half_f"] == 0.5 and abs(few["half_u"] - a["half_u"]) < 1e-12 and abs(few["fx"] - a["fx"]) < 1e-12


@pytest.mark.parametrize("light", [50, quantiles.LIGHT])
def test_quantiles_of_keys_of_any_size(spark, light):
    rnd = np.random.default_rng(6)
    held = {"even": rnd.normal(0, 1, 3000), "ties": np.repeat([1.0, 2.0, 7.0], [990, 2005, 5]), "far": np.concatenate([rnd.normal(0, 1e-6, 1500), rnd.normal(1e12, 1, 1500)]), "one": np.full(2000, 3.5), "nearly": np.concatenate([np.linspace(0, 1, 30), np.full(2970, 1.5)]), "few": np.array([4.0, 1.0]), None: rnd.uniform(0, 1, 400)}
    rows = [(k, float(v), None if k == "few" else float(-v)) for k, vs in held.items() for v in vs] + [("few", None, None)]
    d = spark.createDataFrame(rows, "k string, v double, w double").repartition(7)
    shares = [0.0, 0.05, 0.5, 1 / 3, 0.95, 1.0]
    got = {r["k"]: r for r in quantiles.quantiles(d, ["k"], {"v": shares, "w": [0.5]}, light).collect()}
    assert set(got) == set(held)
    for k, v in held.items():
        assert np.allclose(got[k]["v"], np.quantile(v, shares), rtol=1e-12, atol=1e-15) and got[k]["n"] == len(v) + (k == "few")
        assert got[k]["w"] is None if k == "few" else np.isclose(got[k]["w"][0], -np.median(v), rtol=1e-12, atol=1e-15)


def test_large_and_small_boxes_hold_the_same_points(spark):
    rnd = np.random.default_rng(7)
    rows = [("s", 1, k, *rnd.uniform(0, 100, 2).tolist(), float(rnd.choice([rnd.normal(5, 0.3), rnd.uniform(1, 40)]))) for k in range(3000)]
    projected = spark.createDataFrame(rows, "scene_id string, image_id long, point_id long, u double, v double, depth double")
    found = spark.createDataFrame([("s", 1, k, 10.0 * k, 0.0, 10.0 * k + 25, 100.0 / (k + 1)) for k in range(8)], "scene_id string, image_id long, ordinal long, x0 double, y0 double, x1 double, y1 double")
    plain = {tuple(r) for r in boxes.points_in_boxes(projected, found).select("ordinal", "point_id").collect()}
    assert plain == {tuple(r) for r in boxes.points_in_boxes(projected, found, light=60).select("ordinal", "point_id").collect()} and len(plain) > 500


def test_mass_of_a_cube(spark):
    corners = [(k, *(1.0 + 2 * (k >> b & 1) for b in range(3))) for k in range(8)]
    faces = [(0, 2, 1), (1, 2, 3), (4, 5, 6), (5, 7, 6), (0, 1, 4), (1, 5, 4), (2, 6, 3), (3, 6, 7), (0, 4, 2), (2, 4, 6), (1, 3, 5), (3, 7, 5)]
    v = spark.createDataFrame([("m", *c) for c in corners], "mesh_id string, vid long, x double, y double, z double")
    f = spark.createDataFrame([("m", k, *t) for k, t in enumerate(faces)], "mesh_id string, fid long, a long, b long, c long")
    report = meshes.mesh_report(v, f).first()
    assert (report["vertices"], report["faces"], report["edges"], report["watertight"]) == (8, 12, 18, True) and abs(report["volume"] - 8) < 1e-9
    mass = meshes.mass_properties(v, f, 10.0).first()
    assert abs(mass["mass"] - 80) < 1e-9 and all(abs(mass[f"com_{c}"] - 2) < 1e-9 for c in "xyz")


# Sources


def test_sfm_text(spark, tmp_path):
    scene = tmp_path / "room 1"
    scene.mkdir()
    (scene / "cameras.txt").write_text("# c\n\n1 OPENCV 640 480 500 510 320 240 0.1 0 0 0\n")
    (scene / "images.txt").write_text("# i\n1 1 0 0 0 0.5 0 1 1 e00.jpg\n\n2 1 0 0 0 0 0 1e0 1 e01.jpg\n1.0 2.0 -1 3 4 5\n3 1 0 0 0 7 0 1 1 e00.jpg\n1 2 3 4 5 6 7 8 9 10 11 12\n")
    (scene / "points3D.txt").write_text("5 0.1 0.2 0.3 9 8 7 0.5 1 2\n6 1 2 3\n")
    cameras, images, points = sfm.read_sfm(spark, str(tmp_path))
    assert cameras.first()["params"][:2] == [500.0, 510.0] and cameras.first()["scene_id"] == "room 1"
    assert {(r["image_id"], r["name"], r["tx"]) for r in images.collect()} == {(3, "e00.jpg", 7.0), (2, "e01.jpg", 0.0)}
    assert points.count() == 2 and [tuple(r)[1:] for r in sfm.read_sfm_points(spark, str(tmp_path), rgb=True).collect()] == [(5, 0.1, 0.2, 0.3, 9, 8, 7)]
    (scene / "points3D.txt").write_text("# none\n")
    with pytest.raises(ValueError, match="no points"):
        sfm.read_sfm(spark, str(tmp_path))


def test_frames_ply_and_labels(spark, tmp_path):
    scene = tmp_path / "s1"
    scene.mkdir()
    rows = [[1, 0, 0, 1], [0, 1, 0, 2], [0, 0, 1, 3]]
    (scene / "transforms_train.json").write_text('{"frames": []}')
    (scene / "transforms.json").write_text(str({"w": 640, "fl_x": 500.0, "applied_transform": rows, "frames": [{"file_path": "./images/a.jpg", "transform_matrix": [*rows, [0, 0, 0, 1]]}, {"file_path": "images/b.jpg", "transform_matrix": rows}]}).replace("'", '"'))
    got = sfm.read_camera_frames(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [r["file_path"] for r in got] == ["images/a.jpg", "images/b.jpg"] and got[0]["c2w"] == got[1]["c2w"] == got[0]["applied_transform"]
    header = "ply\nformat {}\nelement vertex 2\nproperty float x\nproperty float y\nproperty float z\nproperty uchar red\nend_header\n"
    (scene / "a.ply").write_text(header.format("ascii 1.0") + "1 2 3 9\n4 5 6 9\n")
    binary = np.array([(1, 2, 3, 9), (4, 5, 6, 9)], np.dtype([("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("r", "u1")])).tobytes()
    (scene / "b.ply").write_bytes(header.format("binary_little_endian 1.0").encode() + binary)
    assert sorted(tuple(r) for r in sfm.read_ply_points(spark, str(tmp_path)).collect()) == [("s1", 0, 1.0, 2.0, 3.0)] * 2 + [("s1", 1, 4.0, 5.0, 6.0)] * 2
    labels = spark.createDataFrame([("k1", 0, 2, 0.5, 0.5, 0.25, 0.125), ("k1", 1, 0, 0.1, 0.1, 0.2, 0.2)], "label_key string, ordinal long, class_id int, xc double, yc double, w double, h double")
    keys = spark.createDataFrame([("k1",), ("k2",)], "label_key string")
    sfm.write_labels2d(labels, keys, str(tmp_path / "labels"))
    assert sorted(p.name for p in (tmp_path / "labels").iterdir() if p.is_dir()) == ["label_key=k1", "label_key=k2"]
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "x.txt").write_text("0 0.5 0.5 0.25 0.25\nbad line\n1 2 3\n")
    assert [tuple(r)[2:] for r in sfm.read_labels2d(spark, str(tmp_path / "l")).collect()] == [(0, 0.5, 0.5, 0.25, 0.25)]


# Streams


def replay(spark, tmp_path, rows, order, pieces, make, mode="append"):
    """Runs a stream over rows that come in several files; returns the last result of the sink."""
    source = str(tmp_path / "in")
    ordered = rows.withColumn("_piece", F.ntile(pieces).over(order))
    for k in range(1, pieces + 1):
        ordered.where(F.col("_piece") == k).drop("_piece").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    name = f"sink_{tmp_path.name.replace('-', '_')}"
    query = make(stream).writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / "state")).start()
    query.processAllAvailable()
    query.stop()
    return spark.table(name)


def test_stream_of_frames_equals_batch(spark, tmp_path):
    from pyspark.sql import Window

    rows = view(spark, SF, "frames").select(F.lit("s").alias("scene_id"), F.col("frame_id").alias("ordinal"), "sharpness", "features", F.timestamp_seconds(F.col("frame_id") * 10).alias("ts"))
    closing = [spark.createDataFrame([("s", -k, 1e9, 10**6)], "scene_id string, ordinal long, sharpness double, features long").withColumn("ts", F.timestamp_seconds(F.lit(10**8 * k))) for k in (1, 2)]
    both = rows.unionByName(closing[0]).unionByName(closing[1])
    # Files overlap in time: frames come up to 30 seconds late.
    got = replay(spark, tmp_path, both, Window.orderBy(F.unix_seconds("ts") + F.col("ordinal") % 4 * 10, "ordinal"), 4, lambda s: streams.stream_frame_qc(s.withWatermark("ts", "60 seconds"), 60.0, 300, 25)).collect()
    checked = dataset.frame_qc(rows, 60.0, 300)
    batch = dataset.saved_ordinal(checked, "scene_id", "ordinal", 25).collect()
    assert {(r["ordinal"], r["saved"]) for r in got} == {(r["ordinal"], r["saved"]) for r in batch} and not any(r["late"] for r in got)
    reasons = [(r["ordinal"], r["reason"]) for r in checked.collect()]
    for r in got:
        assert (r["rejected_blur"], r["rejected_features"]) == tuple(sum(o < r["ordinal"] and why == kind for o, why in reasons) for kind in ("blur", "features"))


def test_late_detections_go_to_a_side_table(spark, tmp_path):
    seconds = [(0, 10), (1, 20), (2, 300), (3, 15), (4, 310), (5, 5000), (6, 9000)]
    rows = spark.createDataFrame([("s", "chair", k, 1 + at, at, 0.5, 0.0, 0.0, 10.0, 10.0) for k, at in seconds], "scene_id string, class_name string, ordinal long, rank int, at long, confidence double, x0 double, y0 double, x1 double, y1 double").withColumn("ts", F.timestamp_seconds("at")).drop("at")
    source, out, late = (str(tmp_path / n) for n in ("in", "out", "late"))
    for k in range(len(seconds)):
        rows.where(F.col("ordinal") == k).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source).withWatermark("ts", "5 seconds")
        query = streams.split_late(streams.stream_tracks(stream), out, late).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination(240)
        assert not query.isActive

    run()
    run()  # goes on from the checkpoint: nothing twice
    assert [r["ordinal"] for r in spark.read.parquet(late).collect()] == [3]
    assert sorted(r["ordinal"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 4, 5]


def test_a_repeated_batch_of_trials_changes_nothing(spark, tmp_path):
    trials = view(spark, SF, "trials").where("ordinal < 40").select("ordinal", "kind", "status", "quality_score", F.col("ordinal").alias("at"))
    later = trials.where("ordinal % 3 = 0").withColumns({"quality_score": F.lit(1.0), "at": F.col("at") + 1000})
    source, path = str(tmp_path / "in"), str(tmp_path / "store")
    for part in (trials, later):
        part.coalesce(1).write.mode("append").parquet(source)
        query = streams.store_trials(spark.readStream.schema(part.schema).parquet(source), path, ["ordinal"], "at").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination(240)
    got = {r["ordinal"]: r["at"] for r in spark.read.parquet(Folder(spark, path).latest()).collect()}
    assert got == {r["ordinal"]: r["ordinal"] + 1000 * (r["ordinal"] % 3 == 0) for r in trials.collect()}
    upsert(trials, path, ["ordinal"], Folder(spark, path).number())
    assert got == {r["ordinal"]: r["at"] for r in spark.read.parquet(Folder(spark, path).latest()).collect()}


def test_stream_of_tracks_equals_batch(spark, tmp_path):
    from pyspark.sql import Window

    rows = tracks.frame_rank(view(spark, SF, "detections").where("ordinal < 400")).withColumn("ts", F.timestamp_seconds(F.col("rank") * 10))
    rows = rows.select("scene_id", "class_name", "ordinal", "rank", "ts", "confidence", "x0", "y0", "x1", "y1")
    last = rows.groupBy("scene_id", "class_name").agg(F.max("ordinal").alias("ordinal"))
    closing = last.select("scene_id", "class_name", F.lit(-1).cast("long").alias("ordinal"), F.lit(10_000).alias("rank"), F.timestamp_seconds(F.lit(100_000_000)).alias("ts"), *[F.lit(0.0).alias(c) for c in ("confidence", "x0", "y0", "x1", "y1")])
    both = rows.unionByName(closing).unionByName(closing.withColumns({"ordinal": F.lit(-2).cast("long"), "rank": F.lit(10_001), "ts": F.timestamp_seconds(F.lit(200_000_000))}))
    got = replay(spark, tmp_path, both, Window.orderBy("ts", "ordinal"), 4, lambda s: streams.stream_tracks(s.withWatermark("ts", "5 seconds"))).where("ordinal >= 0 AND NOT late").collect()
    batch = tracks.associate_detections(rows.withColumn("frame", F.format_string("%06d", "rank")).drop("rank")).collect()
    assert {(r["scene_id"], r["class_name"], r["ordinal"], r["track"]) for r in got} == {(r["scene_id"], r["class_name"], r["ordinal"], r["track"]) for r in batch}


def test_streams_of_states(spark, tmp_path):
    from pyspark.sql import Window

    trials = view(spark, SF, "trials")
    got = replay(spark, tmp_path, trials, Window.orderBy("ordinal"), 2, streams.stream_trials, "complete").collect()
    want = quality.best_trial(trials, ("kind",)).collect()
    assert {(r["kind"], r["ordinal"]) for r in got} == {(r["kind"], r["ordinal"]) for r in want}
