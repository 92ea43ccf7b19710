"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from seqrisk.session import cut_lineage as saved  # noqa: F401  (a table in the shared checkpoint folder)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A side of a join is broadcast only if it was counted and has at most so many rows.
BROADCAST_ROWS = 200_000


def by_value(module: str) -> None:
    """Ship a module's code with the tasks that use it, so that executors need
    no copy of this library."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters, also those with a case, stay."""
    return F.translate(text, UPPER, UPPER.lower())


def null_safe(left: str, right: str, cols: list[str]) -> Column:
    """Equality of ``cols`` between two aliased frames, null equal to null."""
    on = F.lit(True)
    for c in cols:
        on = on & F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`"))
    return on


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` (a saved table) may be broadcast."""
    return df.limit(limit + 1).count() <= limit


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
