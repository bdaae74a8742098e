"""Exact quantiles of keys of any size: small keys in one aggregation buffer, large ones by distributed selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaframe.functions.geometry import let
from vistaframe.sources.tables import Scratch, written

#: Values of a key that one buffer may hold.
LIGHT = 1 << 16
#: Parts that a round of selection cuts a key's values in, and the accuracy of the sketch that finds the cuts.
CUTS, ACCURACY = 32, 1024


def at_share(ordered: Column, share: float) -> Column:
    """The quantile of an array in order, between two values linearly; null of an empty one."""
    place = (F.size(ordered) - 1) * F.lit(share)
    low = F.floor(place).cast("int")
    a, b = F.get(ordered, low), F.get(ordered, F.least(low + 1, F.size(ordered) - 1))
    return F.when(F.size(ordered) > 0, a + (b - a) * (place - low))


def quantiles(rows: DataFrame, key: list[str], wanted: dict[str, list[float]], light: int = LIGHT) -> DataFrame:
    """(key, n, and for each column of wanted an array of its quantiles at these shares): exact, between two values linearly.

    n counts the key's rows. Nulls are no values; a column without values is null. A key of at most `light` rows is one
    aggregation buffer. Larger keys are selected from: a mergeable sketch of bounded size cuts their values in CUTS parts, the
    parts are counted, and only those that hold the wanted ranks go on to the next round, until `light` values are left.
    Keys may be null.
    """
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    if counted.where(F.col("n") > light).isEmpty():
        return _arrays(rows, key, wanted)
    scratch = Scratch()
    heavy = scratch.written(counted.where(F.col("n") > light))
    large = rows.select(F.struct(*key).alias("_key"), *[F.col(c).cast("double").alias(f"_{k}") for k, c in enumerate(wanted)])
    keys = heavy.select(F.struct(*key).alias("_key"), "n")
    small = rows.join(heavy.select(*key, F.lit(True).alias("_heavy")), [rows[k].eqNullSafe(heavy[k]) for k in key], "left_anti")
    found = _arrays(small, key, wanted)
    melted = large.join(keys.select("_key"), "_key", "left_semi").select("_key", F.explode(F.array(*[F.struct(F.lit(k).alias("c"), F.col(f"_{k}").alias("v")) for k in range(len(wanted))])).alias("_p")).select("_key", "_p.c", "_p.v").where("v IS NOT NULL")
    selected = _selected(scratch, melted, list(wanted.values()), light)
    columns = keys.select("_key", "n")
    for k, c in enumerate(wanted):
        mine = selected.where(F.col("c") == k).groupBy("_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias(c))
        columns = columns.join(mine, "_key", "left")
    result = written(found.union(columns.select(*[F.col(f"_key.{k}") for k in key], "n", *wanted)))
    scratch.drop()
    return result


def _arrays(rows: DataFrame, key: list[str], wanted: dict[str, list[float]]) -> DataFrame:
    """quantiles() where a key's values fit in an array."""
    held = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.struct(*[F.col(c).cast("double").alias(f"_{k}") for k, c in enumerate(wanted)])).alias("_all"))
    ordered = lambda k: F.array_sort(F.filter(F.transform("_all", lambda v: v[f"_{k}"]), lambda v: v.isNotNull()))
    shares = lambda k, s: let(ordered(k), lambda v: F.when(F.size(v) > 0, F.array(*[at_share(v, x) for x in s])))
    return held.select(*key, "n", *[shares(k, s).alias(c) for k, (c, s) in enumerate(wanted.items())])


def _selected(scratch: Scratch, values: DataFrame, shares: list[list[float]], light: int) -> DataFrame:
    """(_key, c, at, value): the quantile number `at` of the values (_key, c, v) of each key and column.

    What is broadcast has a row for each quantile wanted of a large key; the values never are, however small their table looks
    (many equal values take few bytes on disk and many in memory).
    """
    target = ["_key", "c", "at"]
    places = F.element_at(F.array(*[F.array(*[F.lit(float(s)) for s in ss]) for ss in shares]), F.col("c") + 1)
    counts = values.groupBy("_key", "c").agg(F.count(F.lit(1)).alias("n")).select("_key", "c", "n", F.posexplode(places).alias("at", "share"))
    state = scratch.written(counts.select(*target, ((F.col("n") - 1) * F.col("share")).alias("place"), F.lit(0).cast("long").alias("below"), "n", F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high")))
    settled = (F.col("n") == 0) | F.coalesce(F.col("low") == F.col("high"), F.lit(False))
    # The first round counts a column's values once for all its quantiles.
    rows, own = scratch.written(values), ["_key", "c"]
    while own != target or not state.where((F.col("n") > light) & (F.col("low") < F.col("high"))).isEmpty():
        # Values that equal a cut are a part of their own, so ties end the search too.
        cuts = F.broadcast(rows.groupBy(*own).agg(F.percentile_approx("v", [k / CUTS for k in range(1, CUTS)], ACCURACY).alias("_cuts")))
        parted = rows.join(cuts, own).withColumn("_part", 2 * F.size(F.filter("_cuts", lambda x: x < F.col("v"))) + F.array_contains("_cuts", F.col("v")).cast("int"))
        parts = parted.groupBy(*own, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("v").alias("_low"), F.max("v").alias("_high"))
        before = Window.partitionBy(*own).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        placed = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(F.broadcast(state.select(*target, "place", "below")), own)
        rank = F.floor("place") - F.col("below")
        holds = (F.col("_before") <= rank + 1) & (F.col("_before") + F.col("_n") > rank)
        # A place between two parts is settled: it lies between the last value of one and the first of the other.
        two = F.count(F.lit(1)) == 2
        n, low, high = F.when(two, 0).otherwise(F.sum("_n")), F.when(two, F.min("_high")).otherwise(F.min("_low")), F.when(two, F.max("_low")).otherwise(F.max("_high"))
        state = scratch.written(placed.where(holds).groupBy(*target, "place", "below").agg(F.min("_before").alias("_b"), n.alias("n"), low.alias("low"), high.alias("high")).select(*target, "place", (F.col("below") + F.col("_b")).alias("below"), "n", "low", "high").union(state.where(settled)))
        rows = scratch.written(rows.join(F.broadcast(state.where("n > 0 AND low < high").select(*target, "low", "high")), own).where("v BETWEEN low AND high").select(*target, "v"))
        own = target
    between = F.col("low") + (F.col("high") - F.col("low")) * (F.col("place") - F.floor("place"))
    known = state.where(settled).select(*target, F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between).alias("value"))
    left = rows.join(F.broadcast(state.where(~settled).select(*target, "place", "below")), target)
    ordered = left.groupBy(*target, "place", "below").agg(F.array_sort(F.collect_list("v")).alias("_v"))
    low = (F.floor("place") - F.col("below")).cast("int")
    a, b = F.get("_v", low), F.get("_v", F.least(low + 1, F.size("_v") - 1))
    return known.union(ordered.select(*target, (a + (b - a) * (F.col("place") - F.floor("place"))).alias("value")))
