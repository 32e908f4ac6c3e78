"""Registry of known tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.operators.quality import NOT_UNIQUE
from tablecheck.operators.rowchange import sync
from tablecheck.operators.skew import SplitHot

_COLUMNS = ("database", "table", "column_name", "test_name")


def triage_rules(null_df: DataFrame, length_df: DataFrame) -> DataFrame:
    """Every known test once: null tests, length tests and the key test."""
    key_test = null_df.sparkSession.range(1).select(
        *[F.lit(None).cast("string").alias(c) for c in _COLUMNS[:-1]],
        F.lit(NOT_UNIQUE).alias("test_name"),
    )
    rules = null_df.select(*_COLUMNS).unionByName(length_df.select(*_COLUMNS))
    return rules.unionByName(key_test).distinct()


def sync_registry(
    registry: DataFrame, triage: DataFrame, *, split_hot: SplitHot = None
) -> DataFrame:
    """Bring the registry in line with the known tests, by test name.

    New tests enter as not blocking, returning ones are un-deleted, vanished
    ones marked deleted. ``is_block`` of a known test is never touched.
    """
    new = {c: c for c in _COLUMNS}
    return sync(
        registry,
        triage,
        ["test_name"],
        matched={},
        not_matched={**new, "is_block": F.lit(False)},
        split_hot=split_hot,
    )
