"""Registry of named queries over the given tables, each with an optional
DuckDB oracle SQL string. ``__spark_entry__`` exposes this registry."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import rnd

_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, digits: int | None = 6):
    """Register a query; double columns are rounded to ``digits`` (engine-neutral)
    and helper columns starting with ``_`` are dropped."""

    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(spark, sf_dir), digits)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


def finish(df: DataFrame, digits: int | None = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name.startswith("_"):
            continue
        if digits is not None and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # plain names take the one-call SQL-text form of the same expression
            c = f.name if _PLAIN.fullmatch(f.name) else F.col(f"`{f.name}`")
            cols.append(rnd(c, digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# --- SQL helpers shared by oracle strings --------------------------------
def R(expr: str, d: int = 6) -> str:
    """Oracle twin of ``functions.columns.rnd``."""
    s = float(10 ** d)
    return (f"(CASE WHEN abs({expr}) * {s!r}::DOUBLE < 9e15::DOUBLE "
            f"THEN floor(({expr}) * {s!r}::DOUBLE + 0.5::DOUBLE) / {s!r}::DOUBLE ELSE ({expr}) END)")


TX = """(SELECT event_id AS id, user_id AS entity, ts,
    (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000000.0::DOUBLE AS "Time",
    value AS "Amount", CAST(event_type = 'error' AS INTEGER) AS y,
    value / (value + 50.0::DOUBLE) AS p,
    floor(value / (value + 50.0::DOUBLE) * 100.0::DOUBLE) / 100.0::DOUBLE AS p2,
    event_type, props FROM events)"""


def VROWS(n: int = 28) -> str:
    vs = ", ".join(f'CAST(embedding[{k}] AS DOUBLE) AS "V{k}"' for k in range(1, n + 1))
    return f'(SELECT vec_id AS id, {vs}, CAST(label = 0 AS INTEGER) AS "Class" FROM embeddings)'


def values_table(name: str, cols: tuple[str, ...], rows: list[tuple]) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, float):
            return f"{v!r}::DOUBLE"
        if v is None:
            return "NULL"
        return str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS {name}({', '.join(cols)}))"


def S(expr: str, d: int = 9) -> str:
    """Oracle twin of ``functions.columns.sig``."""
    x = f"({expr})"
    k = f"({d - 1} - floor(log10(abs{x})))"
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) OR {x} = 0 OR isinf({x}) THEN {x} "
            f"WHEN {k} >= 0 THEN floor({x} * pow(10.0::DOUBLE, {k}) + 0.5::DOUBLE) / pow(10.0::DOUBLE, {k}) "
            f"ELSE floor({x} / pow(10.0::DOUBLE, -{k}) + 0.5::DOUBLE) * pow(10.0::DOUBLE, -{k}) END)")


def card_sql(n: int = 28) -> str:
    vs = ", ".join(f'CAST(m.embedding[{k}] AS DOUBLE) AS "V{k}"' for k in range(1, n + 1))
    return f"""(SELECT e.event_id AS id, e.user_id AS entity, e.ts,
    (epoch_us(e.ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000000.0::DOUBLE AS "Time", {vs},
    e.value AS "Amount", CAST(e.event_type = 'error' AS INTEGER) AS "Class", e.value / (e.value + 50.0::DOUBLE) AS p
  FROM events e JOIN embeddings m
    ON e.event_id % (SELECT count(*) FROM embeddings) = m.vec_id % (SELECT count(*) FROM embeddings))"""


CARD = card_sql()
