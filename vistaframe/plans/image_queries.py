"""Queries over pixels, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaframe.operators.places import with_places
from vistaframe.operators.similarity import pixel_metrics
from vistaframe.plans.helpers import Registry, rounded
from vistaframe.sources.fixtures import view

R = Registry()

#: Pixels of the orders in three images of 25 columns, and means under the whole stencil of 121 pixels.
STENCIL = """g AS (SELECT image_id % 3 AS image_id, row_number() OVER (PARTITION BY image_id % 3 ORDER BY px) - 1 AS k, count(*) OVER (PARTITION BY image_id % 3) // 25 AS h, ref, render FROM pixel_pairs),
p AS (SELECT image_id, k % 25 AS x, k // 25 AS y, h, ref AS a, render AS b FROM g WHERE k < h * 25),
d AS (SELECT i - 5 AS dx, j - 5 AS dy, exp(-((i-5)**2 + (j-5)**2) / 4.5) AS w FROM range(11) i(i), range(11) j(j)),
m AS (SELECT p.image_id, p.x, p.y, sum(w*q.a)/sum(w) AS a, sum(w*q.b)/sum(w) AS b, sum(w*q.a*q.a)/sum(w) AS aa, sum(w*q.b*q.b)/sum(w) AS bb, sum(w*q.a*q.b)/sum(w) AS ab FROM p, d, p q WHERE q.image_id = p.image_id AND q.x = 24 - abs(24 - abs(p.x + dx)) AND q.y = p.h - 1 - abs(p.h - 1 - abs(p.y + dy)) GROUP BY ALL),
s AS (SELECT image_id, avg((2*a*b + 1e-4) * (2*(ab - a*b) + 9e-4) / ((a*a + b*b + 1e-4) * (aa - a*a + bb - b*b + 9e-4))) AS ssim FROM m GROUP BY 1)"""


def _pixels(spark, d):
    rows = view(spark, d, "pixel_pairs").withColumn("image_id", F.col("image_id") % 3)
    placed = with_places(rows, "image_id", ["px"], "k", "n").withColumn("height", F.floor(F.col("n") / 25)).where("k < height * 25")
    return placed.select("image_id", F.lit(0).alias("channel"), (F.col("k") % 25).alias("x"), F.floor(F.col("k") / 25).alias("y"), F.lit(25).alias("width"), "height", "ref", "render")


@R.query(f"WITH {STENCIL} SELECT image_id, round(ssim, 6) AS ssim FROM s", "pixel_pairs")
def ssim(spark, d):
    return rounded(pixel_metrics(_pixels(spark, d), ["image_id"]).select("image_id", "ssim"))


@R.query(f"WITH {STENCIL}, e AS (SELECT image_id, avg((a-b)**2) AS mse FROM p GROUP BY 1) SELECT image_id, round(ssim, 6) AS ssim, round(CASE WHEN mse <= 1e-12 THEN CAST('Infinity' AS DOUBLE) ELSE 10*log10(1/mse) END, 6) AS psnr FROM s JOIN e USING (image_id)", "pixel_pairs")
def view_metrics(spark, d):
    return rounded(pixel_metrics(_pixels(spark, d), ["image_id"], tile=16).select("image_id", "ssim", "psnr"))
