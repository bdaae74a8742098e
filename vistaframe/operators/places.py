"""The place of a row in an order within its key, without a key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vistaframe.sources.tables import written


def with_places(rows: DataFrame, key: str, order: list[str], name: str = "_at", total: str | None = None) -> DataFrame:
    """rows with their place from 0 in order within key, and with total how many rows the key has.

    Rows are dealt by ranges of (key, order), so a key with most rows is spread over many parts; a part is numbered by itself
    and begins after the parts of its key before it. Of the parts only counts are ordered by key. The ranges are drawn by
    samples, so they are written once.
    """
    ranged = written(rows.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(key).alias("_key"), "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(key)).alias("_total"))
    inside = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1
    placed = ranged.withColumn("_inside", inside)
    joined = placed.join(starts.withColumnRenamed("_part", "_own"), placed[key].eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_own")))
    more = [] if total is None else [F.col("_total").alias(total)]
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_before") + F.col("_inside")).alias(name), *more)
