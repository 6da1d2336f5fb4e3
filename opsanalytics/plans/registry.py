"""Catalogue of driver-table queries and their DuckDB oracle SQL.

Each query is registered with ``@query(name, sql)``; the callable takes
``(spark, sf_dir)`` and returns a DataFrame whose column names equal the SQL's.
Output columns are normalised by :func:`finish`: doubles rounded, times as text,
so both engines hash the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def finish(df: DataFrame, digits: int = 4, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round doubles (``digits``, per-column ``overrides``) and render times as text."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        dt = f.dataType
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), overrides.get(f.name, digits))
        elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(dt, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def load_all() -> None:
    """Import every query module so its registrations run."""
    from opsanalytics.plans import (  # noqa: F401
        q_clean,
        q_files,
        q_ml,
        q_o2c,
        q_quality,
        q_series,
        q_sources,
        q_stats,
        q_summaries,
    )
