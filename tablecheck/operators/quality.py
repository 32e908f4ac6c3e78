"""Row tests: tag rows, tag keys, and keep quality tables up to date.

Tags of a row key are the names of the tests it failed. In a quality table NULL
means not tested yet, an empty array means passed, and a key that is NULL in
part or shared by several rows carries only ``key_not_unique``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.names import any_null, field
from tablecheck.operators import skew
from tablecheck.operators.rowchange import anti, lookup, merge, update_where
from tablecheck.operators.rules import Rule
from tablecheck.operators.skew import SplitHot
from tablecheck.sources.scratch import stored

TAG = "data_quality_tag"
NOT_UNIQUE = "key_not_unique"

# Rules per mask column. An aggregation carries few wide masks, in a bigint without
# its sign bit. A projection takes many narrow ones: those stay below the size at
# which the JVM stops compiling the generated method.
_WIDE, _NARROW = 63, 16
_MASK = "__mask_"
_COUNT = "__key_count"
_DIGEST = ("__digest_1", "__digest_2")

# Up to so many rules the names are built by one conditional per rule, inside
# generated code. More would make a method too large for the JVM to compile, so
# the names are then picked from a constant array by their bit. Both give the same.
_INLINE = 16

# Rows of a new key that one task adds; a key with more is dealt to several.
_REPEATED_AT_ONCE = 100_000
_ROWS = "__rows"


def tag_rows(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """Key columns and failed tests of every row; a projection, no shuffle."""
    columns = [field(k) for k in keys]
    marked = _marked(df, rules)
    return marked.select(*columns, _failed(rules, _NARROW).alias(TAG))


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with its number of rows; 0 for a key that is NULL in part."""
    columns = [field(k) for k in keys]
    return df.groupBy(*columns).agg(_full_keys(columns).alias("key_count"))


def tag_keys(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """One row per key: failed tests, or ``key_not_unique``.

    Failed tests travel through the aggregation as bits of bigint columns, so it
    stays a hash aggregation whose map side shrinks a frequent key to one row
    per task. Names are put back afterwards. Taking the maximum of the bits is
    exact because they are read only where the key has a single row.
    """
    columns = [field(k) for k in keys]
    masks = [F.max(mask).alias(name) for name, mask in _masks(rules, _WIDE, df).items()]
    grouped = df.groupBy(*columns).agg(_full_keys(columns).alias(_COUNT), *masks)
    tags = F.when(field(_COUNT) == 1, _failed(rules, _WIDE)).otherwise(_not_unique())
    return grouped.select(*columns, tags.alias(TAG))


def with_tags(
    df: DataFrame,
    rules: Sequence[Rule],
    keys: Sequence[str],
    *,
    split_hot: SplitHot = None,
) -> DataFrame:
    """The table itself with a tag column.

    Keys are counted by a 128-bit digest, so no key is shuffled for that, however long it
    is; keys themselves are compared only where a digest repeats. The repeated keys are
    stored in the shared folder: where they turn out few enough, by bytes, Spark broadcasts
    them and the table itself is not shuffled. A window over the key would put all rows of
    a frequent key into one task.
    """
    columns = [field(k) for k in keys]
    digest = [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]
    marked = df.where(~any_null(columns)).select(
        *columns, *[d.alias(n) for d, n in zip(digest, _DIGEST)]
    )
    twice = marked.groupBy(*_DIGEST).agg(F.count(F.lit(1)).alias(_COUNT)).where(F.col(_COUNT) > 1)
    open_ = marked.join(twice.drop(_COUNT), list(_DIGEST), "left_semi")
    repeated = open_.groupBy(*columns).agg(F.count(F.lit(1)).alias(_COUNT)).where(F.col(_COUNT) > 1)
    repeated = stored(repeated.select(*columns), "repeated-keys")
    seen = lookup(df, repeated, [(k, k) for k in keys], _COUNT, split_hot=split_hot)
    seen = _marked(seen, rules)
    tags = F.when(any_null(columns) | field(_COUNT), _not_unique()).otherwise(
        _failed(rules, _NARROW)
    )
    return seen.select(*[field(c) for c in df.columns], tags.alias(TAG))


def quality_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    """Schema of the quality table of ``df``: its key columns and the tags."""
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    return T.StructType([*fields, T.StructField(TAG, T.ArrayType(T.StringType()))])


def seed_quality(
    fact: DataFrame,
    quality: DataFrame,
    keys: Sequence[str],
    *,
    split_hot: SplitHot = None,
) -> DataFrame:
    """Add the fact's rows whose key the quality table lacks, not tested yet.

    Keys compare null-safe, so seeding again adds nothing. Every fact row of a
    new key is added, as many times as the key occurs.
    """
    if split_hot is None or split_hot is False:
        rows = fact.select(*[field(k) for k in keys])
        new = anti(rows, quality, [(k, k) for k in keys], null_safe=True)
        return quality.unionByName(_untested(new, quality, keys))
    return reduce(DataFrame.unionByName, [quality, *_unseen(fact, quality, keys, split_hot)])


def apply_tags(
    quality: DataFrame,
    tags: DataFrame,
    keys: Sequence[str],
    *,
    source_unique: bool = False,
    split_hot: SplitHot = None,
) -> DataFrame:
    """Write tags to the quality rows of equal key.

    Rows whose key is NULL in part get ``key_not_unique``; rows whose key has no
    tags keep what they have. ``source_unique`` says that ``tags`` holds a key
    once, as the result of ``tag_keys`` does.
    """
    written = merge(
        quality,
        tags,
        list(keys),
        matched={TAG: TAG},
        source_unique=source_unique,
        split_hot=split_hot,
    )
    return update_where(written, any_null([field(k) for k in keys]), {TAG: _not_unique()})


def refresh_quality(
    fact: DataFrame, quality: DataFrame, rules: Sequence[Rule], keys: Sequence[str]
) -> DataFrame:
    """Seed, then tag: the quality table after one run over the fact.

    The fact is read and shuffled once, as one aggregation to (key, rows, failed tests)
    whose map side shrinks a frequent key to a row for each task. Known rows take their
    tags from it in a left join; they are hashed for it beside their key, so a bucketed
    table is not read bucket by bucket, and Spark can split a frequent key, as the
    aggregated side holds every key once. New keys are what the quality table lacks;
    their rows are repeated from the count, those of a frequent key by several tasks.
    """
    return refresh_from_counts(count_keys(fact, rules, keys), quality, rules, keys)


def count_keys(
    fact: DataFrame, rules: Sequence[Rule], keys: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Rows and failed tests of each key, for each value of ``by``: counts that can be merged.

    Failed tests are bits, in rule order; they are exact where there is one row.
    """
    masks = [F.max(mask).alias(name) for name, mask in _masks(rules, _WIDE, fact).items()]
    columns = [field(c) for c in [*keys, *by]]
    return fact.groupBy(*columns).agg(F.count(F.lit(1)).alias(_ROWS), *masks)


def merge_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of the same keys, from several parts of a table, as one."""
    masks = [F.max(c).alias(c) for c in counts.columns if c.startswith(_MASK)]
    return counts.groupBy(*[field(k) for k in keys]).agg(F.sum(_ROWS).alias(_ROWS), *masks)


def refresh_from_counts(
    counts: DataFrame, quality: DataFrame, rules: Sequence[Rule], keys: Sequence[str]
) -> DataFrame:
    """The quality table after these keys have been counted; others keep their tags.

    A key that the table lacks gets as many rows as it has in the fact.
    """
    columns = [field(k) for k in keys]
    full = ~any_null(columns)
    tags = F.when(full & (field(_ROWS) == 1), _failed(rules, _WIDE)).otherwise(_not_unique())
    tagged = counts.select(*columns, _ROWS, tags.alias(TAG))

    known = quality.withColumn("__h", F.xxhash64(*columns)).alias("q")
    found = tagged.withColumn("__h", F.xxhash64(*columns)).alias("f")
    # null-safe, so that no filter goes down one of the two uses of the aggregation
    same = reduce(lambda a, b: a & b, [field(k, "q").eqNullSafe(field(k, "f")) for k in keys])
    same = (field("__h", "q") == field("__h", "f")) & same
    kept = F.coalesce(field(TAG, "f"), field(TAG, "q"))
    written = known.join(found, same, "left").select(
        *[
            F.when(any_null([field(k, "q") for k in keys]), _not_unique()).otherwise(kept).alias(TAG)
            if f.name == TAG
            else field(f.name, "q").alias(f.name)
            for f in quality.schema
        ]
    )
    lacking = anti(tagged, quality, [(k, k) for k in keys], null_safe=True)
    return written.unionByName(_repeated(lacking, quality, keys))


def _repeated(lacking: DataFrame, quality: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each new key as often as it occurs, as rows of the quality table."""
    few = lacking.where(field(_ROWS) <= _REPEATED_AT_ONCE)
    pieces = F.sequence(F.lit(0), F.floor((field(_ROWS) - 1) / _REPEATED_AT_ONCE))
    many = (
        lacking.where(field(_ROWS) > _REPEATED_AT_ONCE)
        .withColumn("__piece", F.explode(pieces))
        .withColumn(
            _ROWS,
            F.least(field(_ROWS) - F.col("__piece") * _REPEATED_AT_ONCE, F.lit(_REPEATED_AT_ONCE)),
        )
    )
    tasks = int(lacking.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(tasks, *[field(k) for k in keys], "__piece").drop("__piece")
    rows = few.unionByName(many)
    rows = rows.withColumn("__n", F.explode(F.sequence(F.lit(1), field(_ROWS).cast("int"))))
    return rows.select(
        *[
            (field(f.name) if f.name in (*keys, TAG) else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in quality.schema
        ]
    )


def _unseen(
    fact: DataFrame, quality: DataFrame, keys: Sequence[str], split_hot: SplitHot
) -> tuple[DataFrame, DataFrame]:
    """Fact rows whose key the quality table lacks: those with a full key, and the others.

    Full keys join on plain equality, which can use the quality table's buckets. A
    single key column has one NULL at most to look up, whatever its number of rows.
    """
    pairs = [(k, k) for k in keys]
    partial = any_null([field(k) for k in keys])
    rows = fact.select(*[field(k) for k in keys])
    full = anti(rows.where(~partial), quality.where(~partial), pairs, split_hot=split_hot)
    lacking = anti(
        rows.where(partial),
        quality.where(partial),
        pairs,
        null_safe=True,
        split_hot=skew.ALL_HOT if len(keys) == 1 else split_hot,
    )
    return _untested(full, quality, keys), _untested(lacking, quality, keys)


def _untested(rows: DataFrame, quality: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys as rows of the quality table, not tested yet."""
    return rows.select(
        *[
            (field(f.name) if f.name in keys else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in quality.schema
        ]
    )


def _full_keys(columns: Sequence[Column]) -> Column:
    """Number of rows in which every key part is set."""
    return F.count(F.when(~any_null(columns), F.lit(1)))


def _not_unique() -> Column:
    return F.array(F.lit(NOT_UNIQUE))


def _masks(rules: Sequence[Rule], width: int, df: DataFrame) -> dict[str, Column]:
    """Failed tests of a row as bits, one bigint for every ``width`` rules."""
    masks = {}
    for start in range(0, len(rules), width):
        bits = [
            f"IF({rule.condition_on(df.schema)}, {1 << i}L, 0L)"
            for i, rule in enumerate(rules[start : start + width])
        ]
        masks[f"{_MASK}{start // width}"] = F.expr(" | ".join(bits))
    return masks


def _marked(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumns(_masks(rules, _NARROW, df)) if rules else df


def _bit_set(mask: Column):
    return lambda _, place: F.getbit(mask, place) == 1


def _failed(rules: Sequence[Rule], width: int) -> Column:
    """Names of the failed tests, in rule order and each once, from the mask columns."""
    if not rules:
        return F.array().cast("array<string>")
    words = [rules[i : i + width] for i in range(0, len(rules), width)]
    masks = [field(f"{_MASK}{w}") for w in range(len(words))]
    if len(rules) <= _INLINE:
        results = [
            F.when(F.getbit(masks[0], F.lit(i)) == 1, F.lit(rule.name))
            for i, rule in enumerate(rules)
        ]
        return F.array_distinct(F.array_compact(F.array(*results)))
    passed = reduce(lambda a, b: a & b, [mask == 0 for mask in masks])
    names = [
        F.filter(F.lit([rule.name for rule in word]), _bit_set(mask))
        for word, mask in zip(words, masks)
    ]
    return F.when(passed, F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(*names))
    )
