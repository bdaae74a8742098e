"""Image similarity on tables of pixels: stencils over tiles with a halo, as windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaframe.operators.images import C1, C2, SIGMA, WINDOW

#: Pixels of a tile's side, and how far a stencil reaches.
TILE, REACH = 64, WINDOW // 2


def reflected(at: Column, size: Column) -> Column:
    """The place in 0..size-1 that a place beyond the border mirrors, without the edge itself, as often as it takes."""
    period = 2 * (size - 1)
    inside = F.pmod(at, F.when(period > 0, period).otherwise(1))
    return F.least(inside, F.greatest(period - inside, F.lit(0)))


def halo(at: Column, size: Column, tile: int) -> Column:
    """Array of structs (at, tile): where a row or column of pixels stands in the tiles that reach it, mirrored places included."""
    near = F.array_distinct(F.array(at, -at, 2 * (size - 1) - at))
    places = F.when(size > REACH, near).otherwise(F.sequence(F.lit(-REACH), size - 1 + REACH))
    known = F.filter(places, lambda p: (p >= -REACH) & (p < size + REACH) & (reflected(p, size) == at))
    first = lambda p: F.greatest(F.floor((p - REACH) / tile), F.lit(0)).cast("int")
    last = lambda p: F.least(F.floor((p + REACH) / tile), F.floor((size - 1) / tile)).cast("int")
    return F.flatten(F.transform(known, lambda p: F.transform(F.sequence(first(p), last(p)), lambda t: F.struct(p.alias("at"), t.alias("tile")))))


def pixel_metrics(pixels: DataFrame, key: list[str], tile: int = TILE) -> DataFrame:
    """key, psnr and ssim of pairs of images as rows (key, channel, x, y, width, height, ref, render), values on a scale of 1.

    ssim is the mean over pixels and channels of the similarity under a Gaussian of 11 by 11 pixels, borders mirrored without the
    edge; psnr is infinite for equal images. An image that lacks pixels, repeats one, or has a null value gives nulls. Tiles are
    dealt with the pixels around them in one shuffle, so no task holds an image; both passes of the stencil run in their tile.
    """
    size = {c: F.col(n).cast("int") for c, n in (("x", "width"), ("y", "height"))}
    rows = pixels.select(*key, "channel", F.col("width"), F.col("height"), F.col("ref").alias("a"), F.col("render").alias("b"), halo(F.col("x").cast("int"), size["x"], tile).alias("_x"), halo(F.col("y").cast("int"), size["y"], tile).alias("_y"))
    rows = rows.select("*", F.explode("_x").alias("_h")).select("*", F.col("_h.at").alias("x"), F.col("_h.tile").alias("tx")).drop("_x", "_h")
    rows = rows.select("*", F.explode("_y").alias("_h")).select("*", F.col("_h.at").alias("y"), F.col("_h.tile").alias("ty")).drop("_y", "_h")
    dealt = rows.repartition(*key, "channel", "tx", "ty").withColumns({"aa": F.col("a") * F.col("a"), "bb": F.col("b") * F.col("b"), "ab": F.col("a") * F.col("b"), "_e": (F.col("a") - F.col("b")) * (F.col("a") - F.col("b"))})
    terms = ("a", "b", "aa", "bb", "ab")
    weights = [math.exp(-(k * k) / (2 * SIGMA**2)) for k in range(-REACH, REACH + 1)]

    def blurred(df: DataFrame, along: str, across: str, length: str) -> DataFrame:
        inside = Window.partitionBy(*key, "channel", "tx", "ty", across).orderBy(along)
        mean = lambda c: sum(w / sum(weights) * F.lead(c, k).over(inside) for k, w in enumerate(weights, -REACH))
        kept = [c for c in df.columns if c not in terms]
        core = (F.floor(F.col(along) / tile) == F.col(f"t{along}")) & (F.col(along) >= 0) & (F.col(along) < F.col(length))
        return df.select(*kept, *[mean(c).alias(c) for c in terms]).where(core)

    means = blurred(blurred(dealt, "x", "y", "width"), "y", "x", "height")
    a, b = F.col("a"), F.col("b")
    similar = (2 * a * b + C1) * (2 * (F.col("ab") - a * b) + C2) / ((a * a + b * b + C1) * (F.col("aa") - a * a + F.col("bb") - b * b + C2))
    each = means.groupBy(*key, "channel").agg(F.sum(similar).alias("s"), F.sum("_e").alias("e"), F.count("_e").alias("n"), F.count(similar).alias("m"), F.max(F.col("width").cast("long") * F.col("height")).alias("want"))
    whole = F.bool_and((F.col("n") == F.col("want")) & (F.col("m") == F.col("want")))
    found = each.groupBy(*key).agg(whole.alias("_whole"), (F.sum("e") / F.sum("n")).alias("_mse"), (F.sum("s") / F.sum("n")).alias("_ssim"))
    psnr = F.when(F.col("_mse") <= 1e-12, F.lit(math.inf)).otherwise(10 * F.log10(1 / F.greatest("_mse", F.lit(1e-300))))
    return found.select(*key, F.when(F.col("_whole"), psnr).alias("psnr"), F.when(F.col("_whole"), F.col("_ssim")).alias("ssim"))
