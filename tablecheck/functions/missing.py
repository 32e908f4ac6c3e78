"""Text markers that stand for a missing value, in both directions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.names import field


def normalize_missing(
    df: DataFrame,
    markers: Iterable[str] | Mapping[str, Iterable[str]] = ("None",),
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Turn marker texts into NULL, then fill the columns named in ``defaults``.

    ``markers`` is one list for every string column, or a list per column.
    """
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not isinstance(markers, Mapping):
        markers = {name: list(markers) for name in text}
    cleaned = df.withColumns(
        {
            name: F.when(field(name).isin(list(found)), None).otherwise(field(name))
            for name, found in markers.items()
        }
    ) if markers else df
    return _fill(cleaned, defaults or {})


def mark_missing(
    df: DataFrame,
    marker: str = "None",
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Fill ``defaults`` first, then write ``marker`` into NULL string columns."""
    filled = _fill(df, defaults or {})
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return _fill(filled, {name: marker for name in text})


def _fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    if not values:
        return df
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns(
        {
            name: F.coalesce(field(name), F.lit(value).cast(types[name]))
            for name, value in values.items()
        }
    )
