"""Named queries over the driver's tables: key -> (spark, sf_dir) -> DataFrame.

driver tables (or data Spark derives from them); none filters rows to make
a check cheaper.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .standins import DriverTables

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: Callable[[DriverTables], DataFrame]) -> Callable[[DriverTables], DataFrame]:
        REGISTRY[name] = lambda spark, sf_dir: fn(DriverTables(spark, sf_dir))
        return fn
    return deco


def load_all() -> dict[str, QueryFn]:
    """Import every key module (each registers its keys) and return them."""
    from . import (analytics_keys, cleaning_keys, etl_keys,  # noqa: F401
                   profiling_keys, report_keys, sources_keys)
    return REGISTRY
