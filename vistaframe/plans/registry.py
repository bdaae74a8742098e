"""Every registered query with its oracle."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("camera_queries", "cloud_queries", "quality_queries", "dataset_queries", "scene_queries", "box_queries", "review_queries", "transform_queries", "lift_queries", "name_queries", "image_queries")


def registries() -> list:
    return [import_module(f"vistaframe.plans.{name}").R for name in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for r in registries() for name, f in r.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for r in registries() for name, sql in r.oracles.items()}
