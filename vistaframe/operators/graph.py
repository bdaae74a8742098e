"""Connected components of an edge table, and what a mesh's components are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaframe.sources.tables import written


def components(edges: DataFrame, written: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """(id, component) of every id in edges (a, b): component is the smallest id that links reach.

    Each round gives an id the smallest label among its own and its neighbours', then the label of that label, so a path
    shortens by half or more. A node of many edges is a partial aggregate and a join that may be split. Every round is a
    table that `written` makes; only whether a label changed comes to the driver. No edges give no rows.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "id"))
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("component").alias("_near"))
        nearest = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", F.col("component").alias("_was"), F.least("component", "_near").alias("_via"))
        jump = labels.select(F.col("id").alias("_via"), F.col("component").alias("_far"))
        moved = written(nearest.join(jump, "_via").select("id", F.least("_via", "_far").alias("component"), "_was"))
        labels = moved.select("id", "component")
        if moved.where("component <> _was").isEmpty():
            return labels


def face_components(faces: DataFrame) -> DataFrame:
    """faces (mesh_id, fid, a, b, c) of one mesh with component: the smallest vertex that their edges reach."""
    edges = faces.select(F.col("a"), F.col("b")).union(faces.select("b", "c"))
    return faces.join(components(edges).withColumnRenamed("id", "a"), "a")


def classify_components(located: DataFrame) -> DataFrame:
    """(mesh_id, component, kind, area) from faces with component, area, nz and az, bz, cz (heights of the corners).

    floor: reaches down to within 0.15 of the mesh's lowest point, and is level on average; architecture: at least one unit of
    area and a twentieth of the mesh's; else obstacle.
    """
    mesh = located.groupBy("mesh_id").agg(F.min(F.least("az", "bz", "cz")).alias("_floor"), F.sum("area").alias("_area"))
    parts = located.groupBy("mesh_id", "component").agg(F.min(F.least("az", "bz", "cz")).alias("_low"), F.abs(F.avg(F.coalesce("nz", F.lit(0.0)))).alias("_level"), F.sum("area").alias("area"))
    rows = parts.join(F.broadcast(mesh), "mesh_id")
    floor = (F.col("_low") <= F.col("_floor") + 0.15) & (F.col("_level") >= 0.75)
    wall = F.col("area") >= F.greatest(F.lit(1.0), F.col("_area") * 0.05)
    return rows.select("mesh_id", "component", F.when(floor, "floor").when(wall, "architecture").otherwise("obstacle").alias("kind"), "area")
