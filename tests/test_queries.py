"""Every query with an oracle against DuckDB, and plans."""

import builtins
import dis
import math
import os
from importlib import import_module

import duckdb
import pytest

from vistaframe.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


def plain(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(float(f"{v + 0.0:.9g}"))
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    found = duck.execute(registry.oracle_sql()[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[k]) for k in at) for r in found.fetchall())


@pytest.mark.parametrize("name", ["view_counts", "radius_join", "neighbor_counts", "nearest_join", "points_in_boxes", "mask_votes"])
def test_joins_are_by_key_and_in_the_jvm(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_queries_without_oracle_have_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry_imports_without_the_llm_part():
    import __spark_entry__

    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert os.path.basename(__spark_entry__.__file__) == "__spark_entry__.py"


@pytest.mark.parametrize("name", registry.MODULES)
def test_every_name_that_a_query_uses_is_there(name):
    """A query is only built when it is asked for, so a lost import would show then."""
    module = import_module(f"vistaframe.plans.{name}")
    codes = [f.__code__ for f in vars(module).values() if getattr(f, "__module__", "") == module.__name__ and hasattr(f, "__code__")]
    for code in codes:
        codes += [c for c in code.co_consts if hasattr(c, "co_code")]
        for step in dis.get_instructions(code):
            assert step.opname != "LOAD_GLOBAL" or hasattr(module, step.argval) or hasattr(builtins, step.argval), step.argval
