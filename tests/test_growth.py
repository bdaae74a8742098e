"""What must not grow with the data: broadcasts, rows that meet, and tables on the way."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from vistaframe.operators import boxes, cameras, held, lift, masks, quantiles, spatial, tracks
from vistaframe.plans import registry


def test_values_of_a_quantile_are_never_broadcast(spark):
    """Many equal values are a small file and a large hash table."""
    rows = spark.range(400_000).select((F.col("id") % 2).alias("k"), (F.col("id") % 100 / 100).alias("v"))
    spark.conf.set("spark.sql.maxBroadcastTableSize", "20m")
    try:
        found = {r["k"]: r["v"] for r in quantiles.quantiles(rows, ["k"], {"v": [0.001, 0.25, 0.5, 1.0]}, 1000).collect()}
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert found == {0: pytest.approx([0.0, 0.24, 0.49, 0.98]), 1: pytest.approx([0.01, 0.25, 0.5, 0.99])}


def cloud_and_boxes(spark):
    rnd = np.random.default_rng(11)
    points = spark.createDataFrame([(s, k, *rnd.normal(0, 1.2, 3).tolist()) for s in "ab" for k in range(3000)] + [("a", 9000, float("nan"), 0.0, 0.0)], "scene_id string, point_id long, x double, y double, z double")
    turns = rnd.normal(0, 1, (12, 4))
    turns /= np.linalg.norm(turns, axis=1)[:, None]
    poses = spark.createDataFrame([("ab"[k % 2], k, *turns[k].tolist(), *rnd.normal(0, 0.5, 2).tolist(), 2.0, "PINHOLE", 640, 480, 500.0, 520.0, 320.0, 240.0) for k in range(12)], "scene_id string, image_id long, qw double, qx double, qy double, qz double, tx double, ty double, tz double, model string, width int, height int, fx double, fy double, cx double, cy double")
    found = spark.createDataFrame([("ab"[k % 2], k, b, 100.0 * b - 20, 90.0, 100.0 * b + 180, 300.0) for k in range(12) for b in range(4)], "scene_id string, image_id long, ordinal long, x0 double, y0 double, x1 double, y1 double")
    return points, poses, found


def test_points_in_boxes_are_counted_and_fitted_without_rows_for_them(spark, monkeypatch):
    """By held points, by joins, and with no table written on the way of the first."""
    points, poses, found = cloud_and_boxes(spark)
    joined = {tuple(r)[:3]: tuple(r)[3:] for r in boxes.box_contents(points, poses, found, inner=0.1, fit=True, margin=50.0, most=100).collect()}
    monkeypatch.setattr(boxes, "written", lambda df: pytest.fail("a table was written"))
    monkeypatch.setattr(cameras, "written", lambda df: pytest.fail("a table was written"))
    held = {tuple(r)[:3]: tuple(r)[3:] for r in boxes.box_contents(points, poses, found, inner=0.1, fit=True).collect()}
    assert set(held) == set(joined) and len(held) > 30
    for k, row in held.items():
        assert row[0] == joined[k][0] and row[2] == joined[k][2] and np.allclose(row, joined[k], rtol=1e-9, atol=1e-9)


def test_views_and_votes_make_no_row_for_a_point_in_an_image(spark, monkeypatch):
    points, poses, _ = cloud_and_boxes(spark)
    seen = cameras.visible_projections(points, poses, 0.0).withColumns({"frame": F.col("image_id") % 5, "u": F.col("u") / 12, "v": F.col("v") / 60, "width": F.lit(53), "height": F.lit(8)})
    pixels = spark.createDataFrame([(s, f"i{i}", f, u, v) for s in "ab" for i in range(3) for f in range(4) for u in range(1, 52) for v in range(1, 7) if (u * v + i + f) % 3], "scene_id string, instance_id string, frame long, u long, v long")
    votes = {tuple(r) for r in masks.mask_votes(seen, pixels).collect()}
    views = {tuple(r) for r in cameras.visible_projections(points, poses, 7.0, 4.0).groupBy("scene_id", "point_id").count().collect()}
    monkeypatch.setattr(cameras, "written", lambda df: pytest.fail("a table was written"))
    rows = cameras.turned(poses).withColumns({"frame": F.col("image_id") % 5, "su": F.lit(12.0), "sv": F.lit(60.0), "width": F.lit(53), "height": F.lit(8)})
    assert {tuple(r) for r in masks.cloud_votes(points, rows, pixels).collect()} == votes and len(votes) > 1000
    images, terms = poses.withColumn("camera_id", F.col("image_id")).drop("model", "width", "height", "fx", "fy", "cx", "cy"), poses.withColumn("camera_id", F.col("image_id")).select("scene_id", "camera_id", "model", "width", "height", "fx", "fy", "cx", "cy")
    counted = cameras.view_counts(points, images, terms, 7.0, 4.0)
    assert counted.count() == points.count() and {tuple(r) for r in counted.where("views > 0").collect()} == views and len(views) > 1000


def test_rows_that_meet_in_a_nearest_join_grow_with_the_rows(spark, monkeypatch):
    """A cell as wide as the whole cloud must not make all pairs; results are those of brute force."""
    rnd = np.random.default_rng(3)
    a, b = rnd.uniform(0, 1, (400, 3)), rnd.uniform(0, 1, (4000, 3))
    table = lambda x: spark.createDataFrame([("s", k, *r.tolist()) for k, r in enumerate(x)], "scene_id string, id long, x double, y double, z double")
    widths, real = [], spatial.radius_join
    monkeypatch.setattr(spatial, "radius_join", lambda left, right, width: widths.append(width) or real(left, right, width))
    got = {r["a_id"]: r["b_id"] for r in spatial.nearest_join(table(a), table(b), 2.0).collect()}
    assert widths[0] < 0.1 and got == {k: int(np.argmin(((b - p) ** 2).sum(axis=1))) for k, p in enumerate(a)}


def test_labels_are_merged_without_rows_for_points_in_boxes(spark, monkeypatch):
    """By held points and by rows, with a scene turned by its capture, and with no table written on the way of the first."""
    points, poses, _ = cloud_and_boxes(spark)
    images = poses.select("scene_id", "image_id", "qw", "qx", "qy", "qz", "tx", "ty", "tz").withColumn("camera_id", F.col("image_id"))
    terms = poses.select("scene_id", F.col("image_id").alias("camera_id"), "model", "width", "height", "fx", "fy", "cx", "cy")
    labels = spark.createDataFrame([("ab"[k % 2], k, b, (k + b) % 2, 0.1 + 0.2 * b, 0.45, 0.35, 0.5) for k in range(12) for b in range(5)], "scene_id string, image_id long, ordinal long, class_id int, xc double, yc double, w double, h double")
    captures = spark.createDataFrame([("a", [0.0, -2.0, 0.0, 1.0, 2.0, 0.0, 0.0, 2.0, 0.0, 0.0, 2.0, 3.0], 0.0, 0.6, 0.8)], "scene_id string, matrix array<double>, x double, y double, z double")
    given = (points, images, terms, labels)
    rows = {tuple(r) for r in lift.merged_boxes(*given, distance=1.5, inner=0.1, most=100).collect()}
    columns = ["scene_id", "class_id", "object", "points", "observations", "cx", "cy", "cz", "half_f", "half_r", "half_u", *[a + c for a in "fru" for c in "xyz"]]
    joined = {tuple(r)[:5]: tuple(r)[5:] for r in lift.lift_scene(*given, distance=1.5, inner=0.1, captures=captures, most=100).select(columns).collect()}
    for module in (boxes, cameras, lift):
        monkeypatch.setattr(module, "written", lambda df: pytest.fail("a table was written"))
    assert {tuple(r) for r in lift.merged_boxes(*given, distance=1.5, inner=0.1).collect()} == rows and len(rows) > 40
    found = {tuple(r)[:5]: tuple(r)[5:] for r in lift.lift_scene(*given, distance=1.5, inner=0.1, captures=captures).select(columns).collect()}
    assert set(found) == set(joined) and len(rows) > 2 * len(found)
    assert all(np.allclose(row, joined[k], rtol=1e-9, atol=1e-9) for k, row in found.items())


def test_weighted_shares_are_those_of_repeated_values():
    rnd = np.random.default_rng(2)
    for n in (1, 2, 7, 3000, 9000):
        for values in (rnd.normal(0, 1, n), rnd.integers(0, 3, n) / 7, np.full(n, 0.3), np.append(rnd.normal(0, 1e-9, n), 1e9)):
            counts = rnd.integers(1, 6, len(values))
            assert held.weighted_shares(values, counts, [0.0, 0.05, 0.5, 0.95, 1.0]).tolist() == held.shares(np.repeat(values, counts), [0.0, 0.05, 0.5, 0.95, 1.0]).tolist()


def test_tracks_leave_in_batches_and_not_by_frame(spark, monkeypatch):
    """One row a frame: what Python gives back is as many batches as it took, and one that ends."""
    rows = spark.range(3000).select(F.lit("s").alias("scene_id"), F.col("id").alias("ordinal"), F.format_string("f%06d", "id").alias("frame"), F.when(F.col("id") < 1500, "chair").alias("class_name"), F.lit(0.5).alias("confidence"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), (F.col("id") % 700 + 10.0).alias("x1"), F.lit(10.0).alias("y1"))
    sent, real = [], DataFrame.mapInArrow

    def counted(df, run, schema):
        ordered = df.coalesce(1)
        sent.append([len(list(run(iter(ordered.toArrow().to_batches(1000))))), -(-ordered.count() // 1000)])
        return real(df, run, schema)

    monkeypatch.setattr(DataFrame, "mapInArrow", counted)
    found = {r["ordinal"]: r["track"] for r in tracks.associate_detections(rows).collect()}
    assert len(sent) == 1 and sent[0][0] <= sent[0][1] + 1 and len(found) == 3000
    want = {}
    for first in (0, 1500):
        matcher = tracks.Matcher()
        want |= {k: matcher.frame(k + 1, [(0.5, (0.0, 0.0, k % 700 + 10.0, 10.0))])[0] for k in range(first, first + 1500)}
    assert found == want


def test_neighbours_are_counted_without_pairs(spark, monkeypatch):
    """Against brute force: dense and thin places, copies, rows on the edge of the radius, ids that stand twice, places that aren't finite."""
    rnd = np.random.default_rng(6)
    xyz = np.concatenate([rnd.normal(0, 0.3, (2500, 3)), rnd.normal(0, 3, (500, 3)), np.repeat(rnd.normal(0, 1, (5, 3)), 20, axis=0), np.arange(24).reshape(-1, 1) * [0.5, 0.0, 0.0] - 4.0])
    ids = np.append(np.arange(len(xyz) - 6), np.arange(6))
    monkeypatch.setattr(spatial, "radius_join", lambda *given: pytest.fail("pairs were made"))
    rows = [("s", int(k), *p) for k, p in zip(ids, xyz.tolist(), strict=True)] + [("s", 9000, float("nan"), 0.0, 0.0), ("s", 9001, None, 0.0, 0.0), ("s", 9002, float("inf"), 0.0, 0.0), ("t", 9003, *xyz[0].tolist())]
    found = spatial.neighbor_counts(spark.createDataFrame(rows, "scene_id string, id long, x double, y double, z double"), 0.5).collect()
    near = (((xyz[:, None] - xyz) ** 2).sum(axis=2) <= 0.25) & (ids[:, None] != ids)
    want = np.bincount(ids, weights=near.sum(axis=1), minlength=len(xyz)).astype(int)
    assert len(found) == len(rows) and all(r["neighbors"] == (want[r["id"]] if r["id"] < 9000 else 0) for r in found) and want.max() > 500
    cloud = held.Cloud(np.arange(len(xyz)), xyz, 4)
    assert held.near_counts(cloud, np.ones(len(xyz), bool), 1.5).tolist() == (((xyz[cloud.ids][:, None] - xyz) ** 2).sum(axis=2) <= 2.25).sum(axis=1).tolist()


def test_pairs_in_a_radius_are_found_past_held_rows(spark, monkeypatch):
    """Against brute force: dense and thin places, copies, distances that round to the radius, far and unreal places, no scene, blocks of many parts and batches."""
    rnd = np.random.default_rng(8)
    edge = np.array([[-1e-20, 9.0, 9.0], [0.5, 9.0, 9.0], [1.0, 9.0, 9.0], [3.5, 9.0, 9.0], [4e15, 0.0, 0.0], [4e15 + 0.5, 0.0, 0.0], [1e19, 0.0, 0.0], [1e19, 0.5, 0.0], [-1e150, 0.0, 0.0], [-1e150, 0.0, 0.5]])
    xyz = np.concatenate([rnd.normal(0, 0.3, (900, 3)), rnd.normal(0, 3, (500, 3)), np.repeat(rnd.normal(0, 1, (5, 3)), 20, axis=0), np.arange(24).reshape(-1, 1) * [0.5, 0.0, 0.0] - 4.0, edge])
    ids = np.append(np.arange(len(xyz) - 6), np.arange(6))
    kind = "scene_id string, id {}, x double, y double, z double"
    odd = [("s", 9000, float("nan"), 0.0, 0.0), ("s", 9001, None, 0.0, 0.0), ("s", 9002, float("inf"), 0.0, 0.0), (None, 9003, 0.0, 0.0, 0.0), ("t", 9004, *xyz[0].tolist())]
    a = spark.createDataFrame([("s", int(k), *p) for k, p in zip(ids, xyz.tolist(), strict=True)] + odd, kind.format("long"))
    b = spark.createDataFrame([("s", f"b{k}", *p) for k, p in enumerate(xyz.tolist())] + [(s, f"b{k}", *p) for s, k, *p in odd], kind.format("string"))
    assert held.spread_near(a, b, 0.1).where("not _of_b").count() < 6 * len(xyz)
    monkeypatch.setattr(held, "HELD_NEAR", 60)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        assert held.spread_near(a, b, 0.5).agg(F.max("_part")).first()[0] > 5
        for radius in (0.5, 0.0):
            found = sorted(tuple(r) for r in spatial.radius_join(a, b, radius).collect())
            square = ((xyz[:, None] - xyz) ** 2).sum(axis=2)
            left, right = np.nonzero(square <= radius * radius)
            want = sorted([("s", int(ids[i]), f"b{j}", float(np.sqrt(square[i, j]))) for i, j in zip(left, right, strict=True)] + [("t", 9004, "b9004", 0.0)])
            assert [r[:3] for r in found] == [r[:3] for r in want] and np.allclose([r[3] for r in found], [r[3] for r in want], rtol=1e-12)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("name", ["project_w2c", "project_c2w"])
def test_pairs_of_points_and_images_are_spread_over_tasks(spark, name):
    """A cloud of one small file must not be one task: its pairs are many."""
    sizes = registry.queries()[name](spark, "/root/testdata/sf0.01").groupBy(F.spark_partition_id()).count().select("count").collect()
    assert len(sizes) > 50 and max(r[0] for r in sizes) < sum(r[0] for r in sizes) / 10


def repeated_images(spark, to, times, shift=4200):
    """Tables of sf0.001 in which images stand `times` times in the same poses, under ids that differ by shift."""
    for name in ("embeddings", "nation", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{to}/{name}.parquet")
    rows = spark.read.parquet("/root/testdata/sf0.001/supplier.parquet")
    rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).withColumn("s_suppkey", (F.col("s_suppkey") + F.col("k") * shift).cast(rows.schema["s_suppkey"].dataType)).drop("k").write.parquet(f"{to}/supplier.parquet")
    return str(to)


@pytest.mark.parametrize("name", ["project_w2c", "project_c2w"])
def test_points_are_projected_once_for_equal_poses(spark, monkeypatch, tmp_path, name):
    met, real = [], cameras.paired
    monkeypatch.setattr(cameras, "paired", lambda points, poses: met.append(poses.count()) or real(points, poses))
    one = [tuple(r) for r in registry.queries()[name](spark, "/root/testdata/sf0.001").collect()]
    many = [tuple(r) for r in registry.queries()[name](spark, repeated_images(spark, tmp_path, 5)).collect()]
    assert met[0] == met[1] > 1
    assert sorted(many) == sorted((s, p, i + 4200 * k, *rest) for s, p, i, *rest in one for k in range(5))


@pytest.mark.parametrize("name", ["mask_votes", "view_counts", "view_counts_margin"])
def test_images_in_equal_poses_pass_a_block_as_one(spark, monkeypatch, tmp_path, name):
    """As many rows go past the points with every image five times, and votes and views are five times as many."""
    met, real = [], held.past_images
    monkeypatch.setattr(held, "past_images", lambda celled, rows, *given: met.append(rows.count()) or real(celled, rows, *given))
    what = "votes" if name == "mask_votes" else "views"
    one = {tuple(v for k, v in r.asDict().items() if k != what): r[what] for r in registry.queries()[name](spark, "/root/testdata/sf0.001").collect()}
    many = {tuple(v for k, v in r.asDict().items() if k != what): r[what] for r in registry.queries()[name](spark, repeated_images(spark, tmp_path, 5)).collect()}
    assert met[0] == met[1] > 1
    assert many == {k: 5 * n for k, n in one.items()} and any(many.values())


def test_regions_hold_the_centres_of_boxes_that_grow():
    """Whatever joins: points in the middle, far away or in one place, with the origin moved as far as is allowed, around or beside the points."""
    rnd = np.random.default_rng(5)
    found, wide = 0, 0
    for turn in range(120):
        points, up = rnd.normal(0, [2.0, 0.7, 1.5], (400, 3)).T, [np.array([0.0, 0.0, 1.0]), np.array([0.6, 0.0, -0.8])][turn % 2]
        counts, origin = rnd.integers(1, 9, 400).astype(np.int32), rnd.normal(0, [0.05, 1.0, 6.0][turn % 3], 3)
        more, shift = int(counts.sum() / rnd.integers(30, 400)), rnd.uniform(0, 0.3)
        region = held.view_region(points, counts, more, origin, shift, up, 5.0)
        if region is None:
            continue
        place, radius, allowed = region
        found, wide = found + 1, wide + (allowed == np.inf)
        for k in range(4):
            added = [rnd.normal(0, 1, (3, more)), rnd.normal(0, 50, (3, more)), np.full((3, more), 30.0), points[:, :more]][k][:, : rnd.integers(0, more + 1)]
            step = rnd.normal(0, 1, 3)
            moved = origin + step / np.linalg.norm(step) * min(shift, allowed)
            centre = held.view_box(np.hstack([points, added]), moved, up, 5.0, np.append(counts, np.ones(added.shape[1], np.int32)))[:3]
            assert np.linalg.norm(centre - place) <= radius
    assert found > 60 and 10 < wide < found


def test_boxes_of_equal_images_are_looked_at_and_fitted_once(monkeypatch):
    """Objects are those that are fitted anew with every box, whether or not places are let go on the way, and most boxes need no fit."""
    rnd = np.random.default_rng(9)
    cloud = held.Cloud(np.arange(3000), rnd.normal(0, [1.5, 1.5, 0.8], (3000, 3)))
    turns = rnd.normal(0, 1, (24, 4)) / [1, 9, 9, 1]
    q, r, x, y = (turns / np.linalg.norm(turns, axis=1)[:, None]).T
    terms = np.column_stack([1 - 2 * (x * x + y * y), 2 * (r * x - q * y), 2 * (r * y + q * x), 2 * (r * x + q * y), 1 - 2 * (r * r + y * y), 2 * (x * y - q * r), 2 * (r * y - q * x), 2 * (x * y + q * r), 1 - 2 * (r * r + x * x), np.zeros((24, 2)), np.full(24, 3.0), np.tile([500.0, 500.0, 320.0, 240.0], (24, 1))])
    rows = [{"image_id": k, "ordinal": b, **dict(zip(held.VIEW, terms[k % 24], strict=True)), "x0": 130.0 * b, "y0": 60.0, "x1": 130.0 * b + 180, "y1": 400.0} for k in range(480) for b in range(4)]
    boxes, up = pa.Table.from_pylist(rows), np.array([0.0, 0.0, 1.0])
    origin = lambda row: -terms[rows[row]["image_id"] % 24, :9].reshape(3, 3).T @ terms[rows[row]["image_id"] % 24, 9:12]
    given = [(row, at) for row, at, _ in held.contents(cloud, boxes, 8, 10.0)]
    looked, fits, real, look = [], [], held.view_box, held.image_contents
    for distance in (0.4, 1.2):
        own, want, centres, counts, origins = {}, [], [], [], []
        for row, at in given:
            eye = origin(row)
            centre = own.setdefault((row % 96), np.array(real(cloud.xyz[:, at], eye, up, 5.0)[:3]))
            k = next((k for k, c in enumerate(centres) if np.linalg.norm(c - centre) <= distance), len(centres))
            want.append(k)
            if k == len(centres):
                centres, counts, origins = [*centres, centre], [*counts, np.zeros(3000, np.int64)], [*origins, eye]
                counts[k][at] += 1
                continue
            origins[k] = (origins[k] * counts[k].sum() + eye * len(at)) / (counts[k].sum() + len(at))
            counts[k][at] += 1
            some = np.flatnonzero(counts[k])
            centres[k] = np.array(real(cloud.xyz[:, some], origins[k], up, 5.0, counts[k][some])[:3])
        monkeypatch.setattr(held, "view_box", lambda *given: fits.append(1) or real(*given))
        monkeypatch.setattr(held, "image_contents", lambda *given: looked.append(1) or look(*given))
        for kept in (held.KEPT, 5000):
            monkeypatch.setattr(held, "KEPT", kept)
            looked.clear(), fits.clear()
            objects = held.Objects(cloud, distance, 5.0)
            assert [objects.add(at, origin(row), up) for row, at in held.repeated_contents(cloud, boxes, 8, 10.0, objects.let_go)] == want
            assert kept == 5000 or len(looked) == 24 and len(fits) < (0.7 if distance > 1 else 1) * len(given)
            for k in range(len(centres)):
                objects.count(k)
                assert (objects.counts[k] == counts[k][objects.at[k]]).all() and objects.sizes[k] == counts[k].sum()
        monkeypatch.undo()


def test_a_density_rule_counts_neighbours_only_till_they_are_enough(spark, monkeypatch):
    """Against brute force, with ids that stand twice, copies and thin places; nearly nothing is compared in dense ones."""
    rnd = np.random.default_rng(12)
    xyz = np.concatenate([rnd.normal(0, 0.3, (2500, 3)), rnd.normal(0, 4, (500, 3)), np.repeat(rnd.normal(9, 1, (5, 3)), 3, axis=0)])
    ids = np.append(np.arange(len(xyz) - 9), np.repeat([7000, 7001, 7002], 3))
    near = (((xyz[:, None] - xyz) ** 2).sum(axis=2) <= 0.25) & (ids[:, None] != ids)
    want = {int(k): int(near[ids == k].sum()) for k in np.unique(ids)}
    rows = [("s", int(k), *p) for k, p in zip(ids, xyz.tolist(), strict=True)]
    points = spark.createDataFrame(rows, "scene_id string, id long, x double, y double, z double")
    for enough in (1, 2, 40):
        found = {r["id"]: r["neighbors"] for r in spatial.neighbor_counts(points, 0.5, enough).collect()}
        assert all(min(found[k], enough) == min(n, enough) and found[k] <= n for k, n in want.items()) and 0 in found.values()
    compared, real = [], held.spans_of
    monkeypatch.setattr(held, "spans_of", lambda starts, sizes: compared.append(int(sizes.sum())) or real(starts, sizes))
    cloud, own = held.Cloud(np.arange(9000), rnd.uniform(0, 1, (9000, 3)), 32), np.ones(9000, bool)
    held.near_counts(cloud, own, 0.5)
    assert sum(compared) > 100_000
    compared.clear()
    held.near_counts(cloud, own, 0.5, np.full(9000, 3))
    assert sum(compared) < 1000
