"""Registered queries: one per operator of the inventory, each over the
whole driver tables of ``sf_dir``. Results are flat (arrays rendered as
sorted joined strings, doubles rounded to 6 places) so they can be compared
with the DuckDB oracle text in ``catalytics.checks.oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics.sources.catalog import Catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the registered queries (fixed values shared with the oracle).
POPULAR_N = 100
MIN_READERS = 30
PERSONAL_N = 5
AS_OF = "2001-06-30"


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c):
    return F.round(c.cast("double"), 6)


def _catalog(spark: SparkSession, sf: str) -> Catalog:
    return Catalog(spark, sf)


import catalytics.registered  # noqa: E402,F401  (fills QUERIES)
