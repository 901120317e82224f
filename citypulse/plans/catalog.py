"""Query catalog: every registered query with its column contract and,
where the result is SQL-expressible, the DuckDB oracle text.

A query's ``spec`` ("name:type ...", types i=integer, f=float, s=text,
d=date) fixes the output columns of both sides. Floats are rounded the same
way on both sides (round half away from zero on the binary value, 6 digits)
so engine differences in the last bits do not change the hash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.sources.warehouse import Warehouse

DIGITS = 6
# Relative nudge applied before rounding: far above floating-point noise
# (~1e-14) and far below the rounding step, it moves exact decimal ties
# (a mean of 2-decimal values over 32 rows ends in 5 at the 7th decimal)
# off the boundary, so both engines round them the same way.
NUDGE = 1.00000000001


@dataclass
class Query:
    name: str
    ids: str
    spec: list[tuple[str, str]]
    build: Callable[[Warehouse], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def _parse(spec: str) -> list[tuple[str, str]]:
    out = []
    for item in spec.split():
        name, typ = item.rsplit(":", 1)
        out.append((name, typ))
    return out


def register(name: str, ids: str, spec: str, sql: str | None = None):
    def deco(fn: Callable[[Warehouse], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, ids, _parse(spec), fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def _round_spark(c):
    scale = float(10 ** DIGITS)
    x = c.cast("double")
    return F.signum(x) * F.floor(F.abs(x) * F.lit(NUDGE) * scale + 0.5) / scale + F.lit(0.0)


def canonical_spark(df: DataFrame, spec: list[tuple[str, str]]) -> DataFrame:
    cols = []
    for name, typ in spec:
        c = F.col(name)
        if typ == "i":
            c = c.cast("long")
        elif typ == "f":
            c = _round_spark(c)
        elif typ == "d":
            c = F.date_format(c, "yyyy-MM-dd")
        else:
            c = c.cast("string")
        cols.append(c.alias(name))
    return df.select(*cols)


def canonical_sql(sql: str, spec: list[tuple[str, str]]) -> str:
    scale = f"{float(10 ** DIGITS)}::DOUBLE"
    cols = []
    for name, typ in spec:
        q = f'q."{name}"'
        if typ == "i":
            e = f"CAST({q} AS BIGINT)"
        elif typ == "f":
            x = f"CAST({q} AS DOUBLE)"
            e = f"sign({x}) * floor(abs({x}) * {NUDGE!r}::DOUBLE * {scale} + 0.5) / {scale} + 0.0"
        elif typ == "d":
            e = f"strftime({q}, '%Y-%m-%d')"
        else:
            e = f"CAST({q} AS VARCHAR)"
        cols.append(f'{e} AS "{name}"')
    return f"SELECT {', '.join(cols)}\nFROM (\n{sql}\n) q"


def run_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    q = REGISTRY[name]
    return canonical_spark(q.build(Warehouse(spark, sf_dir)), q.spec)


def oracle(name: str) -> str | None:
    q = REGISTRY[name]
    return canonical_sql(q.sql, q.spec) if q.sql else None
