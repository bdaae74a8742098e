"""Meshes, images, lifting, readers and writers on small inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaframe.functions import geometry as G
from vistaframe.operators import cameras as C
from vistaframe.operators import frames, images, lift, meshes, spatial
from vistaframe.operators import transforms as T
from vistaframe.sources import manifests, sfm

EYE = [1.0 if k % 5 == 0 else 0.0 for k in range(16)]
VERTEX = "mesh_id string, vid long, x double, y double, z double"
FACE = "mesh_id string, fid long, a long, b long, c long"
POSE = "scene_id string, image_id long, camera_id int, name string, qw double, qx double, qy double, qz double, tx double, ty double, tz double"
CAMERA = "scene_id string, camera_id int, model string, width int, height int, fx double, fy double, cx double, cy double"


def cube(spark, name="m", side=(1.0, 2.0, 3.0), at=(5.0, 0.0, 0.0)):
    vertices = [(name, k, *[float(at[i] + side[i] * (k >> i & 1)) for i in range(3)]) for k in range(8)]
    quads = [(0, 4, 6, 2), (1, 3, 7, 5), (0, 1, 5, 4), (2, 6, 7, 3), (0, 2, 3, 1), (4, 5, 7, 6)]
    faces = [(name, k, *t) for k, t in enumerate(x for a, b, c, d in quads for x in ((a, b, c), (a, c, d)))]
    return spark.createDataFrame(vertices, VERTEX), spark.createDataFrame(faces, FACE)


def test_a_cube_is_weighed_and_put_about_its_centre(spark):
    vertices, faces = cube(spark)
    made = meshes.finalize_objects(vertices, faces, spark.createDataFrame([("m", EYE)], "mesh_id string, matrix array<double>"), 2.0, production=True)
    mass = made["mass"].first()
    assert math.isclose(mass["mass"], 12.0) and np.allclose([mass["com_x"], mass["com_y"], mass["com_z"]], [5.5, 1.0, 1.5])
    assert np.allclose(mass["inertia"], sorted([12 / 12 * (4 + 9), 12 / 12 * (1 + 9), 12 / 12 * (1 + 4)])) and mass["confidence"] == 0.9
    report = made["report"].first()
    assert report["watertight"] and (report["extent_x"], report["extent_y"], report["extent_z"]) == (1.0, 2.0, 3.0) and math.isclose(report["volume"], 6.0)
    assert np.allclose([abs(r["x"]) for r in made["vertices"].collect()], 0.5)
    assert made["placement"].first()["local_to_world"][3] == 5.5
    assert [r["clamped"] for r in meshes.clamp_extent(made["report"]).collect()] == [True]


def test_an_open_mesh_has_no_mass(spark):
    vertices, faces = cube(spark)
    opened = meshes.mass_properties(vertices, faces.where("fid > 0"), 2.0).first()
    assert (opened["mass"], opened["com_x"], opened["inertia"], opened["confidence"]) == (None, None, None, 0.0)
    with pytest.raises(Exception, match="not watertight"):
        meshes.finalize_objects(vertices, faces.where("fid > 0"), spark.createDataFrame([("m", EYE)], "mesh_id string, matrix array<double>"), 1.0, production=True)["report"].collect()


def test_static_scenes_have_parts_and_artifacts(spark):
    (v1, f1), (v2, f2) = cube(spark), cube(spark, at=(50.0, 0.0, 0.0))
    vertices, faces = v1.union(v2.withColumn("vid", F.col("vid") + 100)), f1.union(f2.select("mesh_id", F.col("fid") + 100, *[(F.col(c) + 100).alias(c) for c in "abc"]))
    none = spark.createDataFrame([], "mesh_id string, matrix array<double>")
    made = meshes.static_scene_report(vertices, faces, none, 12, spark.createDataFrame([("m", "h")], "mesh_id string, transform_hash string"))
    assert made["chunks"].count() == 2 and made["collision"].count() == 12
    assert {r["artifact_id"] for r in made["artifacts"].collect()} >= {"static_collision_mesh", "static_render_proxy"}
    assert {r["transform_hash"] for r in made["artifacts"].collect()} == {"h"}


def test_images_get_smaller_and_lose_their_light(spark):
    rnd = np.random.default_rng(1)
    flat = rnd.integers(90, 160, (40, 60, 3), dtype=np.uint8)
    lit = np.clip(flat * np.linspace(0.3, 1.2, 60)[None, :, None], 0, 255).astype(np.uint8)
    rows = spark.createDataFrame([("a", 40, 60, bytes(lit.tobytes()))], "name string, height int, width int, data binary")
    small = images.downscale_images(rows, ["name"], 4).first()
    assert (small["height"], small["width"]) == (10, 15)
    got = np.frombuffer(small["data"], np.uint8).reshape(10, 15, 3).astype(float)
    assert np.abs(got - lit.reshape(10, 4, 15, 4, 3).mean(axis=(1, 3))).max() <= 0.5001
    mask = images.downscale_images(rows, ["name"], 3, masks=True).first()
    assert set(np.frombuffer(mask["data"], np.uint8)) <= set(lit.reshape(-1))
    even = np.frombuffer(images.delight(rows, ["name"]).first()["data"], np.uint8).reshape(40, 60, 3).astype(float)
    ratio = lambda x: x[:, :20].mean() / x[:, -20:].mean()
    assert abs(ratio(even) - 1) < 0.25 < abs(ratio(lit.astype(float)) - 1)


def test_ply_and_objects_and_trials_round_trip(spark, tmp_path):
    points = spark.createDataFrame([("s1", k, k * 0.5, -1.25, 3.0) for k in range(40)] + [("s2", 7, 0.1, 0.2, 1e-7)], "scene_id string, point_id long, x double, y double, z double")
    sfm.write_ply_points(points, str(tmp_path / "ply"))
    back = sfm.read_ply_points(spark, str(tmp_path / "ply"), "part-*").orderBy("scene_id", "point_id").collect()
    assert len(back) == 41 and [(r["scene_id"], r["x"]) for r in back[:3]] == [("s1", 0.0), ("s1", 0.5), ("s1", 1.0)]
    assert np.allclose([back[-1][c] for c in "xyz"], [0.1, 0.2, 1e-7], rtol=1e-6)
    boxes = spark.createDataFrame([("s1", 3, 0.0, 0.0, 0.0, 2.0, 4.0, 6.0)], "scene_id string, class_id int, lo_x double, lo_y double, lo_z double, hi_x double, hi_y double, hi_z double")
    sfm.write_objects3d(boxes, str(tmp_path / "objects"), "colmap")
    r = sfm.read_objects3d(spark, str(tmp_path / "objects")).first()
    assert (r["cx"], r["hy"], r["r0"], r["r1"]) == (1.0, 2.0, 1.0, 0.0)
    move = spark.createDataFrame([("s1", [0.0, -2.0, 0.0, 1.0, 2.0, 0.0, 0.0, 2.0, 0.0, 0.0, 2.0, 3.0, 0.0, 0.0, 0.0, 1.0])], "scene_id string, matrix array<double>")
    r = sfm.read_objects3d(spark, str(tmp_path / "objects"), move).first()
    assert (r["lo_x"], r["hi_x"], r["cy"], r["hz"]) == (-7.0, 1.0, 4.0, 6.0)
    trials = spark.createDataFrame([("s1", k, f"t{k}", "cheap", "scored", 0.5 * k, {"p": "1"}, {"m": "2"}) for k in (0, 1)], "scene_id string, ordinal int, trial_id string, kind string, status string, quality_score double, params map<string,string>, metrics map<string,string>")
    manifests.write_trials(trials, str(tmp_path / "trials"))
    read = manifests.read_trials(spark, str(tmp_path / "trials"), "part-*.json").orderBy("ordinal").collect()
    assert [(r["scene_id"], r["trial_id"], r["quality_score"], r["metrics"]) for r in read] == [("s1", "t0", 0.0, {"m": "2"}), ("s1", "t1", 0.5, {"m": "2"})]


def test_detections_and_packed_gaussians_are_read(spark, tmp_path):
    (tmp_path / "d" / "s1").mkdir(parents=True)
    (tmp_path / "d" / "s1" / "r.json").write_text('{"frame": "x/f1.jpg", "cls": [0, 5, 9], "conf": [0.5, 0.6, 0.7], "xyxy": [[0, 1, 2, 3], [4, 5, 6, 7], [0, 0, 1, 1]], "names": {"5": "lamp"}}\n')
    got = sfm.read_detections(spark, str(tmp_path / "d"), ["chair"]).orderBy("ordinal").collect()
    assert [(r["scene_id"], r["frame"], r["class_name"], r["y1"]) for r in got] == [("s1", "f1.jpg", "chair", 3.0), ("s1", "f1.jpg", "lamp", 7.0), ("s1", "f1.jpg", "9", 1.0)]
    rows = [([[0.0, 1.0, 2.0], [3.0, 4.0, 5.0]], [0.5, 0.6], [[1.0, 1.0, 1.0]] * 2, [[1.0, 0.0, 0.0, 0.0]] * 2, [float(k) for k in range(6)])]
    spark.createDataFrame(rows, "positions array<array<double>>, opacities array<double>, scales array<array<double>>, orientations array<array<double>>, sh_coeffs array<double>").write.parquet(str(tmp_path / "g" / "s2"))
    packed = sfm.read_gaussians(spark, str(tmp_path / "g")).orderBy("gaussian_id").collect()
    assert [(r["scene_id"], r["x"], r["opacity"], r["qw"], r["sh"]) for r in packed] == [("s2", 0.0, 0.5, 1.0, [0.0, 1.0, 2.0]), ("s2", 3.0, 0.6, 1.0, [3.0, 4.0, 5.0])]
    with pytest.raises(Exception, match="does not hold 4"):
        lift.filter_packed(sfm.read_gaussians(spark, str(tmp_path / "g")), F.lit(True), 4).collect()


def room(spark, n=4000):
    rnd = np.random.default_rng(3)
    pts = rnd.normal(0, 3, (n, 3))
    points = spark.createDataFrame([("a", k, *map(float, p)) for k, p in enumerate(pts)] + [("a", n, float("nan"), 0.0, 0.0)], "scene_id string, point_id long, x double, y double, z double")
    q = rnd.normal(size=(12, 4))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    poses = spark.createDataFrame([("a", k, 1, f"f{k}", *map(float, q[k]), *map(float, rnd.normal(0, 2, 3))) for k in range(12)], POSE)
    return points, poses, spark.createDataFrame([("a", 1, "PINHOLE", 640, 480, 300.0, 310.0, 320.0, 240.0)], CAMERA)


@pytest.mark.parametrize(("margin", "depth"), [(0.0, None), (25.0, 4.0)])
def test_cells_lose_no_projection(spark, margin, depth):
    points, images_, cameras = room(spark)
    poses = C.poses_with_cameras(images_, cameras)
    all_of = C.projections(points, poses).where(C.in_frame(margin, depth))
    some = C.visible_projections(points, poses, margin, depth)
    key = lambda df: {(r["point_id"], r["image_id"]) for r in df.collect()}
    want = key(all_of)
    assert len(want) > 1000 and key(some) == want
    views = {r["point_id"]: r["views"] for r in C.view_counts(points, images_, cameras, margin, depth).collect()}
    assert len(views) == 4001 and views[4000] == 0
    assert all(views[p] == sum(1 for x, _ in want if x == p) for p in range(0, 4000, 97))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_gx" in plan


def test_nearest_of_far_rows_and_of_none(spark):
    row = "scene_id string, id long, x double, y double, z double"
    a = spark.createDataFrame([("a", 1, 1e6, 0.0, 0.0), ("a", 2, 0.0, 0.0, 0.0), ("b", 3, 0.0, 0.0, 0.0), ("a", 4, float("nan"), 0.0, 0.0)], row)
    b = spark.createDataFrame([("a", 9, 1.0, 0.0, 0.0), ("a", 8, -1.0, 0.0, 0.0)], row)
    assert sorted((r["a_id"], r["b_id"], r["distance"]) for r in spatial.nearest_join(a, b, 0.01).collect()) == [(1, 9, 999999.0), (2, 8, 1.0)]
    assert spatial.nearest_join(a, b.limit(0), 0.01).count() == 0


def test_a_tilted_floor_is_found_and_aligned(spark):
    rnd = np.random.default_rng(7)
    floor = np.c_[rnd.uniform(-3, 3, (400, 2)), rnd.normal(0, 0.005, 400)]
    above = np.c_[rnd.uniform(-1, 1, (150, 2)), rnd.uniform(0.3, 2, 150)]
    c, s = math.cos(0.3), math.sin(0.3)
    turn = np.array([[1, 0, 0], [0, c, -s], [0, s, c]])
    pts = np.concatenate([floor, above]) @ turn.T + [0.0, 0.0, 1.5]
    points = spark.createDataFrame([("a", k, *map(float, p)) for k, p in enumerate(pts)], "scene_id string, point_id long, x double, y double, z double")
    # Cameras whose up is the floor's normal, two units above it.
    up = turn @ np.array([0.0, 0.0, 1.0])
    down = -up
    right = np.array([1.0, 0.0, 0.0])
    r = np.stack([right, down, np.cross(right, down)])
    centre = up * 2 + [0.0, 0.0, 1.5]
    w = math.sqrt(max(0.0, 1 + np.trace(r))) / 2
    q = [w, (r[2, 1] - r[1, 2]) / (4 * w), (r[0, 2] - r[2, 0]) / (4 * w), (r[1, 0] - r[0, 1]) / (4 * w)] if w > 1e-6 else [0.0, 1.0, 0.0, 0.0]
    t = -r @ centre
    poses = spark.createDataFrame([("a", 1, 1, "f", *map(float, q), *map(float, t))], POSE)
    got = frames.align_scene(points, poses).first()
    m = np.array(got["matrix"]).reshape(4, 4)
    turned = pts[:400] @ m[:3, :3].T + m[:3, 3]
    assert abs(turned[:, 2].mean()) < 0.02 and got["problem"] is None and got["cameras_above"] == 1.0
    assert frames.align_scene(points, poses, strict=False, least_ratio=0.99).first()["problem"] == "ratio"
    with pytest.raises(Exception, match="fails: ratio"):
        frames.align_scene(points, poses, least_ratio=0.99).collect()


def test_transforms_that_are_no_similarity_are_errors(spark):
    one = spark.range(1)
    bad = [F.lit(x) for x in (1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, -1.0)]
    zero = [F.lit(0.0)] * 3
    for r, scale, text in ((bad, 1.0, "right-handed"), ([F.lit(2.0)] * 9, 1.0, "orthonormal"), ([F.lit(1.0 if k % 4 == 0 else 0.0) for k in range(9)], 0.0, "positive")):
        with pytest.raises(Exception, match=text):
            one.select(G.compose_similarity(r, zero, F.lit(scale))).collect()
    with pytest.raises(Exception, match="positive"):
        one.select(G.meters_per_unit(F.lit(0.0), F.lit(1.0))).collect()
    scenes = spark.createDataFrame([("a", "production")], "scene_id string, build_mode string")
    none = spark.createDataFrame([], "scene_id string, source string, target string, matrix array<double>")
    with pytest.raises(Exception, match="no transform from colmap to usd"):
        T.source_to_target(scenes, none).collect()
