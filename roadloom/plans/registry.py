"""Queries by name, each with the SQL that says the same to another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: tuple[str, ...] = ()):
    """Registers a query under its function's name, with oracle SQL if there is any."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = with_views(sql, *views) if views else sql
        return f

    return keep


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, as sums depend on the order of their terms; no negative zeros."""
    return df.select(*[(F.round(c, places) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
