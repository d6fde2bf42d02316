"""The registered queries of the document engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import geometry_q, notes_q, scalars, tables_q

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {key: scalars.query(key) for key in scalars.SCALARS} | tables_q.QUERIES | notes_q.QUERIES | geometry_q.QUERIES


def oracle_sql() -> dict[str, str]:
    return {key: scalars.oracle(key) for key in scalars.SCALARS} | tables_q.ORACLES | notes_q.ORACLES | geometry_q.ORACLES
