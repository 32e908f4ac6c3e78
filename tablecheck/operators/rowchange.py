"""Row-level changes as DataFrame operators: upsert, update, soft delete, sync.

The parquet tables of the session catalog take no MERGE or UPDATE, so each
operator returns the changed relation and ``sources.tables.replace_table``
stores it.

Keys are compared with plain equality: a NULL key part never matches, so such a
target row stays as it is and such a source row counts as new. In column
expressions ``t.`` names the target row and ``s.`` the source row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.names import any_null, field
from tablecheck.operators import skew

Keys = Sequence[str] | Mapping[str, str]
Values = Mapping[str, "Column | str"]

_IN_S = "__in_source"
_COPIES = "__source_copies"
_SCOPED = "__in_scope"

_MANY = "merge: more than one source row matches the same target row"


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Keys,
    matched: Values | None = None,
    not_matched: Values | str | None = None,
    *,
    source_unique: bool = False,
    split_hot: skew.SplitHot = None,
) -> DataFrame:
    """Update target rows that have a source row, insert source rows that have none.

    ``matched`` and ``not_matched`` map target columns to an expression, or to
    the name of a source column. ``not_matched="*"`` inserts the columns both
    sides share; a column nothing is given for becomes NULL. ``None`` leaves that
    branch out. The result has the target's columns, order and types.

    Two source rows for one updated target row are an error at run time;
    ``source_unique=True`` skips that check where the caller knows the keys to be
    unique. A source that Spark can broadcast leaves a large target unshuffled.
    No Spark job starts before the result is used, unless ``split_hot=True`` asks to look
    for frequent keys (see ``skew``).
    """
    pairs = _pairs(on)
    inserts = _inserts(target, source, not_matched)
    if matched is None:
        if inserts is None:
            return target
        new = anti(source, target, [(s, t) for t, s in pairs], split_hot=split_hot)
        return target.unionByName(new.alias("s").select(*inserts))
    return _change(
        target,
        source,
        pairs,
        _updates(target, matched),
        inserts,
        guard=not source_unique,
        split_hot=split_hot,
    )


def update_where(df: DataFrame, condition: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns where the condition holds; a NULL condition changes nothing.

    Every value is computed from the row as it was.
    """
    types = {f.name: f.dataType for f in df.schema}
    changed = {}
    for name, value in values.items():
        new = value if isinstance(value, Column) else F.lit(value)
        changed[name] = F.when(condition, new.cast(types[name])).otherwise(field(name))
    return df.withColumns(changed)


def soft_delete(
    target: DataFrame,
    source: DataFrame,
    on: Keys,
    scope: Keys | None = None,
    flag: str = "is_deleted",
    *,
    split_hot: skew.SplitHot = None,
) -> DataFrame:
    """Set ``flag`` on target rows whose key the source no longer has.

    With ``scope`` only rows whose scope columns appear in the source are
    flagged, e.g. the databases that were just read. Rows with a NULL key part
    stay as they are.
    """
    pairs = _pairs(on)
    seen = lookup(target, source, pairs, _IN_S, split_hot=split_hot)
    gone = ~field(_IN_S) & ~any_null([field(t) for t, _ in pairs])
    if scope is not None:
        seen = _in_scope(seen, source, scope, split_hot)
        gone = gone & field(_SCOPED)
    return update_where(seen, gone, {flag: True}).select(*[field(c) for c in target.columns])


def sync(
    target: DataFrame,
    source: DataFrame,
    on: Keys,
    matched: Values,
    not_matched: Values | str = "*",
    scope: Keys | None = None,
    flag: str = "is_deleted",
    *,
    source_unique: bool = False,
    split_hot: skew.SplitHot = None,
) -> DataFrame:
    """Upsert, soft delete and reactivate in one join.

    Rows on both sides are updated and un-flagged, source-only rows inserted
    un-flagged, target-only rows flagged if they are in scope.
    """
    pairs = _pairs(on)
    off = {flag: F.lit(False)}
    updates = _updates(target, {**matched, **off})
    inserts = _inserts(target, source, not_matched, extra=off)
    gone = ~any_null([field(t, "t") for t, _ in pairs])
    known = target
    found = split_hot
    if split_hot is True:
        found = skew.find_hot(target, source, pairs, True, both=not source_unique)
    if scope is not None:
        known = _in_scope(target, source, scope, split_hot)
        gone = gone & field(_SCOPED, "t")
    kept = [
        (F.when(gone, F.lit(True)).otherwise(field(c, "t")) if c == flag else field(c, "t"))
        for c in target.columns
    ]
    return _change(
        known,
        source,
        pairs,
        updates,
        inserts,
        guard=not source_unique,
        split_hot=found,
        kept=kept,
        schema=target.schema,
    )


def _in_scope(
    rows: DataFrame, source: DataFrame, scope: Keys, split_hot: skew.SplitHot
) -> DataFrame:
    """Mark the rows whose scope the source holds.

    Scopes are few as a rule. Where Spark cannot tell, the rows are shuffled by scope, and
    adaptive execution splits the large partitions that few scopes make.
    """
    return lookup(rows, source, _pairs(scope), _SCOPED, split_hot=_other_keys(split_hot))


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    flag: str,
    *,
    split_hot: skew.SplitHot = None,
) -> DataFrame:
    """Add a boolean column: does the right side hold the row's key?"""
    names = [r for _, r in on]
    keys = right.select(*[field(r) for r in names]).distinct()
    keys = keys.where(~any_null([field(r) for r in names]))

    parts = []
    for a, b, hot in skew.split(left, keys, on, split_hot, both=False):
        b = b.select("*", F.lit(True).alias(flag))
        if hot:  # unique keys, so no more rows than frequent keys
            joined = a.alias("t").join(F.broadcast(b).alias("s"), _condition(on), "left")
        else:
            t, s, same = skew.spread(a, b, on)
            joined = t.join(s, same & _condition(on), "left")
        columns = [field(c, "t") for c in left.columns]
        parts.append(joined.select(*columns, F.coalesce(field(flag, "s"), F.lit(False)).alias(flag)))
    return reduce(DataFrame.unionByName, parts)


def anti(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    *,
    null_safe: bool = False,
    split_hot: skew.SplitHot = None,
) -> DataFrame:
    """Rows of the left side whose key the right side does not hold.

    The right keys are made distinct before they are shuffled, so copies of one
    key there do not pile up in one task.
    """
    keys = right.select(*[field(r) for _, r in on]).distinct()
    if not null_safe:
        keys = keys.where(~any_null([field(r) for _, r in on]))
    condition = _condition(on, null_safe)
    parts = []
    for a, b, hot in skew.split(left, keys, on, split_hot, both=False):
        if hot:  # unique keys, so no more rows than frequent keys
            rest = a.alias("t").join(F.broadcast(b).alias("s"), condition, "left_anti")
        else:
            t, s, same = skew.spread(a, b, on, null_safe)
            rest = t.join(s, same & condition, "left_anti")
        parts.append(rest.select(*[field(c, "t") for c in left.columns]))
    return reduce(DataFrame.unionByName, parts)


def _change(
    target: DataFrame,
    source: DataFrame,
    pairs: Sequence[tuple[str, str]],
    updates: list[Column],
    inserts: list[Column] | None,
    *,
    guard: bool,
    split_hot: skew.SplitHot,
    kept: list[Column] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Join target and source and build each output row from the side it came from.

    Known rows come from a left join with a source that holds every key once, in which
    Spark can split the partitions of the target; new ones are the source rows whose key
    the target lacks. Of the target's keys, only those the source holds are looked at for
    that: a source that Spark broadcasts finds them without a shuffle of the target.
    """
    schema = schema or target.schema
    names = [f.name for f in schema]
    kept = kept or [field(n, "t") for n in names]
    condition = _condition(pairs)
    source_keys, target_keys = [field(s) for _, s in pairs], [field(a) for a, _ in pairs]

    def rows(t: DataFrame, s: DataFrame, same: Column) -> DataFrame:
        joined = t.join(s, same, "left")
        if guard:
            joined = joined.where(_one_source_row())
        found = field(_IN_S, "s")
        return joined.select(
            *[F.when(found, updates[i]).otherwise(kept[i]).alias(n) for i, n in enumerate(names)]
        )

    def change(t: DataFrame, s: DataFrame, hot: bool) -> DataFrame:
        keys = t.select(*target_keys).distinct().where(~any_null(target_keys))
        asked = s.select(*source_keys).alias("s")
        if hot:  # distinct keys of the target, no more than there are frequent ones
            keys = F.broadcast(keys)
            # At most one source row per key may match, and the guard stops the run on
            # the second one, so this side has no more rows than there are such keys.
            s_known = s.alias("s").join(keys.alias("t"), condition, "left_semi")
            one = F.broadcast(_unique(s_known, source_keys, guard)).alias("s")
            done = rows(t.alias("t"), one, condition)
        else:
            left, one, same = skew.spread(t, _unique(s, source_keys, guard), pairs)
            done = rows(left, one, same & condition)
            keys = keys.alias("t").join(asked, condition, "left_semi")
        if inserts is None:
            return done
        flipped = [(b, a) for a, b in pairs]
        new = anti(s, keys, flipped, split_hot=skew.ALL_HOT if hot else None)
        return done.unionByName(new.alias("s").select(*inserts))

    parts = skew.split(target, source, pairs, split_hot, both=guard)
    return reduce(DataFrame.unionByName, [change(*part) for part in parts])


def _unique(source: DataFrame, keys: list[Column], guard: bool) -> DataFrame:
    """The source's rows that can match, marked; with ``guard`` one for each key, and how many.

    The rows of a key shrink to one for each task before they are shuffled.
    """
    rows = source.where(~any_null(keys))
    if guard:
        named = [key.alias(f"__key_{i}") for i, key in enumerate(keys)]
        one = F.first(F.struct(*[field(c) for c in source.columns])).alias("__row")
        counted = rows.groupBy(*named).agg(one, F.count(F.lit(1)).alias(_COPIES))
        rows = counted.select("__row.*", _COPIES)
    return rows.withColumn(_IN_S, F.lit(True))


def _one_source_row() -> Column:
    """Filter condition that stops the run on a second match of a target row.

    It is a filter and not a projection, because a projected check is pruned
    away under ``count()``.
    """
    many = field(_COPIES, "s") > 1
    return F.when(many, F.raise_error(F.lit(_MANY)).cast("boolean")).otherwise(F.lit(True))


def _condition(pairs: Sequence[tuple[str, str]], null_safe: bool = False) -> Column:
    tests = [
        field(a, "t").eqNullSafe(field(b, "s")) if null_safe else field(a, "t") == field(b, "s")
        for a, b in pairs
    ]
    return reduce(lambda a, b: a & b, tests)


def _pairs(on: Keys) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(name, name) for name in on]


def _other_keys(split_hot: skew.SplitHot) -> skew.SplitHot:
    """The option for other columns: keys found for the key do not apply to them."""
    return split_hot if isinstance(split_hot, bool) else None


def _value(value: Column | str) -> Column:
    return field(value, "s") if isinstance(value, str) else value


def _updates(target: DataFrame, matched: Values) -> list[Column]:
    """New value of each target column for a row found on both sides."""
    _check(target, matched)
    return [
        _value(matched[f.name]).cast(f.dataType) if f.name in matched else field(f.name, "t")
        for f in target.schema
    ]


def _inserts(
    target: DataFrame,
    source: DataFrame,
    not_matched: Values | str | None,
    extra: Mapping[str, Column] | None = None,
) -> list[Column] | None:
    """Value of each target column for a row found in the source only."""
    if not_matched is None:
        return None
    if not_matched == "*":
        given = {c: c for c in target.columns if c in source.columns}
    else:
        given = dict(not_matched)
    given.update(extra or {})
    _check(target, given)
    return [
        (_value(given[f.name]) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema
    ]


def _check(target: DataFrame, values: Mapping[str, object]) -> None:
    unknown = [name for name in values if name not in target.columns]
    if unknown:
        raise ValueError(f"not columns of the target: {', '.join(unknown)}")
