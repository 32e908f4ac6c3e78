"""Property text, as catalogs print it, to a map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablecheck.functions.names import field


def parse_properties(text: str | Column) -> Column:
    """``[k=v, k=v]`` to ``map<string,string>``.

    A comma that is followed by another comma is a value, so
    ``delimiter=,,quote=x`` yields a delimiter of ``,``. Values keep any further
    ``=``. Of a name that is repeated the last value counts. Empty text and NULL give
    NULL.
    """
    col = field(text) if isinstance(text, str) else text
    bare = F.regexp_replace(col, r"^\[|\]$", "")
    pairs = F.transform(F.split(bare, r",(?!,)\s*"), lambda pair: F.split(pair, "=", 2))
    names = F.transform(pairs, lambda pair: pair[0])
    last = F.filter(
        pairs,
        lambda pair, i: F.array_position(F.reverse(names), pair[0]) == F.size(names) - i,
    )
    repeated = F.size(F.array_distinct(names)) < F.size(names)
    pairs = F.when(repeated, last).otherwise(pairs)
    entries = F.transform(pairs, lambda pair: F.struct(pair[0], F.get(pair, F.lit(1))))
    return F.when(bare != "", F.map_from_entries(entries))
