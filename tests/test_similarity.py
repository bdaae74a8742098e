"""Stencils over tiles against whole images in numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaframe.operators import images
from vistaframe.operators.similarity import pixel_metrics

PIXEL = "name string, channel int, x int, y int, width int, height int, ref double, render double"


def rows(name, one, two):
    h, w, channels = one.shape
    return [(name, c, x, y, w, h, float(one[y, x, c]), float(two[y, x, c])) for y in range(h) for x in range(w) for c in range(channels)]


@pytest.mark.parametrize("tile", [12, 64])
def test_similarity_of_images_of_all_sizes(spark, tile):
    random = np.random.default_rng(3)
    pairs = {f"{h}x{w}": (random.random((h, w, 3)), random.random((h, w, 3))) for h, w in ((1, 1), (1, 9), (2, 3), (5, 6), (6, 5), (13, 12), (40, 71))}
    smooth = images.blur(random.random((30, 24, 3)))
    pairs |= {"equal": (smooth, smooth), "near": (smooth, smooth + 0.01 * random.random(smooth.shape))}
    table = spark.createDataFrame([r for name, (one, two) in pairs.items() for r in rows(name, one, two)], PIXEL)
    found = {r["name"]: r for r in pixel_metrics(table.repartition(7), ["name"], tile).collect()}
    assert found.keys() == pairs.keys()
    for name, (one, two) in pairs.items():
        mse = ((one - two) ** 2).mean()
        assert found[name]["ssim"] == pytest.approx(images.ssim(one, two), abs=1e-12), name
        assert found[name]["psnr"] == (math.inf if mse <= 1e-12 else pytest.approx(10 * np.log10(1 / mse)))


def test_images_that_are_not_whole_have_no_similarity(spark):
    one = np.random.default_rng(4).random((8, 9, 2))
    known = spark.createDataFrame(rows("n", one, one[::-1]), PIXEL)
    name = lambda df, n: df.withColumn("name", F.lit(n))
    table = known.unionByName(name(known.where("NOT (x = 3 AND y = 3 AND channel = 1)"), "hole")).unionByName(name(known.unionByName(known.where("x = 0 AND y = 1")), "twice"))
    table = table.unionByName(name(known.withColumn("render", F.when(F.col("x") != 8, F.col("render"))), "null"))
    found = {r["name"]: (r["psnr"], r["ssim"]) for r in pixel_metrics(table, ["name"]).collect()}
    assert found["hole"] == found["twice"] == found["null"] == (None, None) and found["n"][1] is not None
    assert pixel_metrics(known.limit(0), ["name"]).count() == 0


def test_tiles_are_dealt_once_and_stay_in_the_jvm(spark):
    table = spark.createDataFrame([], PIXEL)
    plan = pixel_metrics(table, ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange hashpartitioning(name#") <= 3
