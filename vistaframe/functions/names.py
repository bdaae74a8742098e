"""Column builders for file names, keys, hashes and small lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings of videos; density in kg per cubic metre, friction and restitution, and roughness and metallic, by material.
VIDEO_SUFFIXES = (".mp4", ".m4v", ".mov", ".avi", ".mkv", ".webm", ".wmv", ".mpg", ".mpeg")
PHYSICS = {"generic": (700.0, 0.5, 0.05), "cardboard": (200.0, 0.55, 0.02), "plastic": (950.0, 0.4, 0.1), "wood": (650.0, 0.55, 0.05), "metal": (7800.0, 0.35, 0.08)}
MATERIALS = {"generic": (0.6, 0.0), "cardboard": (0.8, 0.0), "plastic": (0.45, 0.0), "wood": (0.65, 0.0), "metal": (0.3, 0.9)}


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, "[^/]*$", 0), r"\.[^.]*$", "")


def frame_label_key(path: Column) -> Column:
    """A relative path without suffix, its slashes made underscores; a leading ./ is dropped."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"^(\./)+", ""), r"\.[^./]*$", ""), "/", "_")


def frame_index(name: Column) -> Column:
    """N of a stem frame_N in any case; else null."""
    return F.regexp_extract(name, r"(?i)^frame_(\d+)$", 1).try_cast("long")


def frame_sort_key(name: Column) -> Column:
    """The first run of digits as a number, 0 without one."""
    return F.coalesce(F.regexp_extract(name, r"\d+", 0).try_cast("long"), F.lit(0))


def session_of(path: Column) -> Column:
    """The folder a frame lies in; else what stands before a double underscore in its name; else default."""
    folder = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    prefix = F.regexp_extract(stem(path), r"^(.+?)__", 1)
    return F.when(folder != "", folder).when(prefix != "", prefix).otherwise("default")


def class_slug(name: Column) -> Column:
    """Lower-case letters and digits, all else underscores, none at the ends; object if nothing is left."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("object"))


def display_name(identifier: Column) -> Column:
    return F.initcap(F.regexp_replace(identifier, "_", " "))


def hash_bucket(key: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on seed and key only: the first 32 bits of their SHA-256."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key).cast("binary"), 256), 1, 8), 16, 10).cast("double") / 4294967295.0


def matrix_hash(m: Column) -> Column:
    """16 hex digits that name a matrix, its terms rounded to nine places."""
    return F.substring(F.sha2(F.to_json(F.transform(m, lambda x: F.bround(x, 9))).cast("binary"), 256), 1, 16)


def supported_video(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.[^./]*$", 0)).isin(*VIDEO_SUFFIXES)


def template(name: Column, values: dict[str, tuple], fields: tuple[str, ...], generic: tuple | None = None) -> Column:
    """A struct of the named template's fields; unknown and null names are generic, whose values `generic` may override."""
    base = generic or values["generic"]
    choice = F.lit(None)
    for k, field in enumerate(fields):
        value = F.lit(base[k])
        for known, own in values.items():
            if known != "generic":
                value = F.when(name == known, own[k]).otherwise(value)
        choice = [value.alias(field)] if k == 0 else [*choice, value.alias(field)]
    return F.struct(*choice)
