"""Registration of queries, and rounding for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaframe.sources.fixtures import oracle


class Registry:
    """Queries of a module by name, and oracle SQL over the named fixture views."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None, *views: str) -> Callable:
        def add(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql is not None:
                self.oracles[f.__name__] = oracle(sql, *views) if views else sql
            return f

        return add


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """df with its doubles rounded; a rounded zero has no sign."""
    return df.select(*[(F.round(c, places) + F.lit(0.0)).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def solved(source: str, keep: str) -> str:
    """SQL for keep and e0 <= e1 <= e2, the eigenvalues of the symmetric matrix a b c (diagonal) d e f (xy, xz, yz) of each row of source, in closed form."""
    shifted = f"(SELECT *, (a+b+c)/3 AS q, sqrt(((a-(a+b+c)/3)**2 + (b-(a+b+c)/3)**2 + (c-(a+b+c)/3)**2 + 2*(d*d+e*e+f*f))/6) AS p FROM {source})"
    angled = f"(SELECT *, acos(greatest(-1, least(1, CASE WHEN p > 0 THEN ((a-q)*((b-q)*(c-q)-f*f) - d*(d*(c-q)-e*f) + e*(d*f-e*(b-q))) / (2*p*p*p) ELSE 1 END)))/3 AS phi FROM {shifted})"
    return f"SELECT {keep}, q + 2*p*cos(phi + 2*pi()/3) AS e0, 3*q - (q + 2*p*cos(phi)) - (q + 2*p*cos(phi + 2*pi()/3)) AS e1, q + 2*p*cos(phi) AS e2 FROM {angled}"


def axis(value: str, name: str) -> str:
    """SQL list of the unit eigenvector of that eigenvalue: the longest product of two rows of the matrix less the value, its largest component positive."""
    rows = [(f"(a-{value})", "d", "e"), ("d", f"(b-{value})", "f"), ("e", "f", f"(c-{value})")]
    products = []
    for i, j in ((0, 1), (0, 2), (1, 2)):
        u, v = rows[i], rows[j]
        x = [f"{u[1]}*{v[2]}-{u[2]}*{v[1]}", f"{u[2]}*{v[0]}-{u[0]}*{v[2]}", f"{u[0]}*{v[1]}-{u[1]}*{v[0]}"]
        products.append(f"{{'l': {'+'.join(f'({t})**2' for t in x)}, 'v': [{', '.join(x)}]}}")
    longest = f"list_max([{', '.join(products)}])"
    return f"list_transform([{longest}], lambda m: list_transform(m.v, lambda t: t / sqrt(m.l) * sign(list_max(list_transform(m.v, lambda u: {{'s': abs(u), 'u': u}})).u)))[1] AS {name}"
