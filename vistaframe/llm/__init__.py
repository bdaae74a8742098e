"""Operators of a training-data pipeline. QUERIES and ORACLES are what __spark_entry__ registers."""

from importlib import import_module

MODULES = ("revisits", "mixing", "jaccard", "toxicity", "quality", "audio", "licenses", "records", "neighbours", "packing", "negatives", "repeats", "spellings")

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _name in MODULES:
    _module = import_module(f"{__name__}.{_name}")
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
