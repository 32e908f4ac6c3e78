"""The batch run over catalog databases: dictionary, layout, quality, registry.

Every step reads tables, changes them with the operators and stores the result.
An exception stops the run.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.names import field
from tablecheck.operators import layout, quality, registry, rowchange, rules
from tablecheck.sources import dictionary as shapes
from tablecheck.sources import folders, landing
from tablecheck.sources.scratch import stored
from tablecheck.sources.tables import (
    add_columns,
    append_rows,
    ensure_table,
    is_foreign,
    lay_out_columns,
    load,
    overwrite_partitions,
    quoted,
    replace_table,
    rewrite_partitions,
    table_detail,
    table_layout,
    table_properties,
)

DICTIONARY = "dictionary_quality"
BUCKETS = 10
ROWS_PER_BUCKET = 1_000_000
FOLDERS_AT_ONCE = 10_000


def create_dictionary(spark: SparkSession, dictionary: str = DICTIONARY) -> None:
    """Create the column and table dictionaries and the registry where absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(dictionary)}")
    ensure_table(
        spark, f"{dictionary}.column", shapes.COLUMN_DICTIONARY, partition_by=["table_id"]
    )
    ensure_table(spark, f"{dictionary}.table", shapes.TABLE_DICTIONARY, partition_by=["table_id"])
    ensure_table(spark, f"{dictionary}.is_block", shapes.REGISTRY, partition_by=["database"])


def run_landing(
    spark: SparkSession, databases: Sequence[str], dictionary: str = DICTIONARY
) -> None:
    """Land columns and tables of the databases and sync both dictionaries."""
    create_dictionary(spark, dictionary)
    columns, tables = _landed(spark, databases, dictionary)
    replace_table(columns, f"{dictionary}.column")
    replace_table(tables, f"{dictionary}.table")


def _landed(
    spark: SparkSession, databases: Sequence[str], dictionary: str
) -> tuple[DataFrame, DataFrame]:
    """Both dictionaries as they are after a landing."""
    columns = landing.land_database_columns(spark, databases)
    facts = landing.land_database_tables(spark, databases)
    creates = landing.land_create_statements(spark, databases)
    return landing.sync_columns(load(spark, f"{dictionary}.column"), columns), landing.sync_tables(
        load(spark, f"{dictionary}.table"), landing.stage_table_metadata(facts, creates)
    )


def run_layout(spark: SparkSession, database: str, dictionary: str = DICTIONARY) -> list[str]:
    """Order columns by name in the dictionary, then in the tables themselves."""
    columns = layout.reorder_alphabetically(load(spark, f"{dictionary}.column"), database)
    replace_table(columns, f"{dictionary}.column")
    return apply_layout_all(spark, database, dictionary)


def apply_layout_all(
    spark: SparkSession, database: str, dictionary: str = DICTIONARY
) -> list[str]:
    """Give every table of the database the dictionary's order; returns those changed.

    Where files name their columns and types stay, only the registered columns change
    and no file does. Other tables are rewritten, but for files of other formats at a
    location of their own, which are skipped, as views are. A table that is laid out
    already is left alone. Partition columns stay last, where file tables keep them, with
    their comments.
    """
    laid = layout.Layout(
        load(spark, f"{dictionary}.column"), load(spark, f"{dictionary}.table"), database
    )
    changed = []
    for _, table in landing.list_tables(spark, [database]):
        if laid.is_view(table):
            continue
        name = f"{database}.{table}"
        now = load(spark, name)
        laid_out = laid.apply(now, table)
        partition_by, _ = table_layout(spark, name)
        if _described(laid_out, partition_by) == _described(now, partition_by):
            continue
        try:
            lay_out_columns(spark, name, laid_out.schema)
        except ValueError:
            if is_foreign(table_detail(spark, name)):
                continue
            replace_table(laid_out, name)
        changed.append(table)
    return changed


def configure_rules(
    spark: SparkSession,
    keys: Mapping[str, str],
    null_tests: Sequence[str] = (),
    length_tests: Mapping[str, int] | None = None,
    dictionary: str = DICTIONARY,
    databases: Sequence[str] | None = None,
) -> None:
    """Add the rule columns to the dictionaries and set keys and tests.

    Only tables and columns of ``databases`` are set, if those are given.
    """
    columns, tables = _configured(
        load(spark, f"{dictionary}.column"),
        load(spark, f"{dictionary}.table"),
        keys,
        null_tests,
        length_tests or {},
        databases,
    )
    replace_table(tables, f"{dictionary}.table")
    replace_table(columns, f"{dictionary}.column")


def _configured(
    columns: DataFrame,
    tables: DataFrame,
    keys: Mapping[str, str],
    null_tests: Sequence[str],
    length_tests: Mapping[str, int],
    databases: Sequence[str] | None,
) -> tuple[DataFrame, DataFrame]:
    """Both dictionaries with the rule columns, keys and tests."""
    tables = add_columns(tables, shapes.TABLE_KEY, after="description")
    for table, key in keys.items():
        tables = rules.set_key(tables, [table], key, databases)
    columns = add_columns(columns, shapes.COLUMN_RULES)
    if null_tests:
        columns = rules.set_null_test(columns, null_tests, databases=databases)
    for column, length in length_tests.items():
        columns = rules.set_length_test(columns, [column], length, databases)
    return columns, tables


def run_quality(
    spark: SparkSession,
    database: str,
    tables: Sequence[str],
    dictionary: str = DICTIONARY,
    buckets: int | None = None,
) -> None:
    """Test every listed table and store the tags in its ``quality_<table>``.

    Unless ``buckets`` says otherwise, there is a bucket for every ``ROWS_PER_BUCKET``
    rows of the fact, as counted, ``BUCKETS`` at least, never fewer than before, and no
    more than Spark allows.
    """
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    column_rows = load(spark, f"{dictionary}.column")
    table_rows = load(spark, f"{dictionary}.table")
    nulls, lengths = rules.null_rules(column_rows), rules.length_rules(column_rows)
    for table in tables:
        keys = rules.resolve_key(table_rows, database, table)
        compiled = rules.compile_rules(nulls, lengths, database, table)
        fact = load(spark, f"{database}.{table}")
        name = f"{dictionary}.quality_{table}"
        number = buckets or bucket_number(fact.count(), most)
        ensure_table(spark, name, quality.quality_schema(fact, keys), bucket_by=(number, keys))
        _, now = table_layout(spark, name)
        if buckets is None and now:
            number = max(number, now[0])  # never fewer than before
        number = min(number, most)
        replace_table(
            quality.refresh_quality(fact, load(spark, name), compiled, keys),
            name,
            bucket_by=(number, keys),
        )


def bucket_number(rows: int, most: int) -> int:
    """Buckets for so many rows: a task that groups a bucket by its key holds its rows at once."""
    return min(most, max(BUCKETS, math.ceil(rows / ROWS_PER_BUCKET)))


def run_quality_increment(
    spark: SparkSession, database: str, table: str, dictionary: str = DICTIONARY
) -> int:
    """Bring the quality table in line with folders landed since; returns how many.

    ``table`` holds one partition per landed folder, as ``land_files`` stores it. Beside
    the quality table stands a state, ``state_<table>``: the rows and failed tests of each
    key in each folder. A run reads the fact's new folders only, looks their keys up in the
    state, and tags those keys anew; the result is that of a full run over all folders. The
    state takes the new folders last, so a run that was cut off is simply run again. Other
    rules make a new state, for which all folders are new once more.
    """
    column_rows, table_rows = load(spark, f"{dictionary}.column"), load(spark, f"{dictionary}.table")
    keys = rules.resolve_key(table_rows, database, table)
    compiled = rules.compile_rules(
        rules.null_rules(column_rows), rules.length_rules(column_rows), database, table
    )
    fact = load(spark, f"{database}.{table}")
    state, name = f"{dictionary}.state_{table}", f"{dictionary}.quality_{table}"
    asked = str([tuple(rule) for rule in compiled])
    if spark.catalog.tableExists(quoted(state)) and table_properties(spark, state).get(_RULES) != asked:
        spark.sql(f"DROP TABLE {quoted(state)}")
    shape = quality.count_keys(fact, compiled, keys, ["folder"]).schema
    ensure_table(spark, state, shape, partition_by=["folder"], properties={_RULES: asked})
    ensure_table(spark, name, quality.quality_schema(fact, keys), bucket_by=(BUCKETS, keys))
    known = load(spark, state)
    new = _partition_folders(spark, f"{database}.{table}") - _partition_folders(spark, state)
    if not new:
        return 0
    fresh = fact.where(F.col("folder").isin(sorted(new)))
    fresh = stored(quality.count_keys(fresh, compiled, keys, ["folder"]), "key-counts")
    # null-safe, since a key that is NULL in part is counted like any other
    same = [field(k, "t").eqNullSafe(field(k, "s")) for k in keys]
    before = known.alias("t").join(
        fresh.select(*[field(k) for k in keys]).distinct().alias("s"),
        reduce(lambda a, b: a & b, same),
        "left_semi",
    )
    changed = quality.merge_counts(before.unionByName(fresh), keys)
    replace_table(quality.refresh_from_counts(changed, load(spark, name), compiled, keys), name)
    overwrite_partitions(fresh.select(*[field(c) for c in known.columns]), state)
    return len(new)


# Property of a state: the rules that its bits stand for.
_RULES = "tablecheck.rules"


def _partition_folders(spark: SparkSession, name: str) -> set[str]:
    """The folders that a table holds, as the catalog lists them."""
    rows = spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect()
    return {unquote(row[0].split("=", 1)[1]) for row in rows}


def run_registry(spark: SparkSession, dictionary: str = DICTIONARY) -> None:
    """Sync the registry with the tests the dictionary asks for."""
    columns = load(spark, f"{dictionary}.column")
    triage = registry.triage_rules(rules.null_rules(columns), rules.length_rules(columns))
    known = load(spark, f"{dictionary}.is_block")
    replace_table(registry.sync_registry(known, triage), f"{dictionary}.is_block")


def run_pipeline(
    spark: SparkSession,
    databases: Sequence[str],
    keys: Mapping[str, str],
    null_tests: Sequence[str] = (),
    length_tests: Mapping[str, int] | None = None,
    dictionary: str = DICTIONARY,
    buckets: int | None = None,
) -> None:
    """Land, lay out, test and register, for the tables that have a key in ``keys``.

    A key names its table alone, and so does a quality table; a table of that name in
    two of the databases is an error. Keys and tests are set in these databases only.
    Landing, order and rules are put together first, and each dictionary is stored once.
    """
    names = [t for _, t in landing.list_tables(spark, databases) if t in keys]
    if len(names) > len(set(names)):
        raise ValueError("tables with a key must have different names")
    create_dictionary(spark, dictionary)
    columns, tables = _landed(spark, databases, dictionary)
    for database in databases:
        columns = layout.reorder_alphabetically(columns, database)
    columns, tables = _configured(columns, tables, keys, null_tests, length_tests or {}, databases)
    replace_table(tables, f"{dictionary}.table")
    replace_table(columns, f"{dictionary}.column")
    for database in databases:
        apply_layout_all(spark, database, dictionary)
    for database in databases:
        present = {table for _, table in landing.list_tables(spark, [database])}
        run_quality(spark, database, [t for t in keys if t in present], dictionary, buckets)
    run_registry(spark, dictionary)


def merge_table(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    on: rowchange.Keys,
    matched: rowchange.Values | None = None,
    not_matched: rowchange.Values | str | None = None,
    **options,
) -> int:
    """Merge into a stored table; returns how many of its partitions were rewritten.

    Of a partitioned table only the partitions that hold a row to be updated are read and
    rewritten, and new rows are appended: the files of all others stay as they are. That is
    two writes; run again after a cut between them, the merge adds what is missing. A
    table without partitions, or one whose partition columns are updated, is replaced.
    """
    target = load(spark, name)
    partition_by, _ = table_layout(spark, name)
    if not partition_by or set(partition_by) & set(matched or ()):
        replace_table(rowchange.merge(target, source, on, matched, not_matched, **options), name)
        return -1
    pairs = rowchange._pairs(on)
    count = 0
    if matched is not None:
        keys = source.select(*[field(s).alias(f"__k{i}") for i, (_, s) in enumerate(pairs)]).distinct()
        same = [field(t, "t") == field(f"__k{i}", "s") for i, (t, _) in enumerate(pairs)]
        rows = target.select(*dict.fromkeys([*partition_by, *[t for t, _ in pairs]])).alias("t")
        hit = rows.join(keys.alias("s"), reduce(lambda a, b: a & b, same), "left_semi")
        count = rewrite_partitions(
            spark,
            name,
            hit.select(*partition_by),
            lambda inside: rowchange.merge(inside, source, on, matched, **options),
        )
    if not_matched is not None:
        target = load(spark, name)
        unknown = rowchange.anti(source, target, [(s, t) for t, s in pairs])
        append_rows(rowchange.merge(target.where("false"), unknown, on, None, not_matched), name)
    return count


def land_files(
    spark: SparkSession,
    path: str,
    table: str,
    ledger: str,
    fmt: str = "parquet",
    folders_at_once: int = FOLDERS_AT_ONCE,
    **options: str,
) -> int:
    """Land the new folders below ``path`` in a table; returns how many there were.

    The first folders give the table its schema, later ones never alter it. Rows
    are stored in one partition per folder, and a folder enters the ledger after
    its rows: after a run that was cut off the same folders land again, in place of
    what it left, and no row lands twice. Folders land in rounds of about
    ``folders_at_once``, whose names are all that the driver holds; the ledger takes
    them from the listing.
    """
    ensure_table(spark, ledger, shapes.LEDGER)
    found = stored(folders.new_folders(spark, path, load(spark, ledger)), "new-folders")
    count = found.count()
    rounds = math.ceil(count / folders_at_once)
    for number in range(rounds):
        part = found.where(F.pmod(F.xxhash64("folder"), F.lit(rounds)) == number)
        names = [row["folder"] for row in part.collect()]
        if not names:
            continue
        schema = None
        if spark.catalog.tableExists(quoted(table)):
            fields = load(spark, table).schema.fields
            schema = T.StructType([f for f in fields if f.name != "folder"])
        landed = folders.read_folders(spark, path, names, fmt, schema, **options)
        if schema is None:
            # the table stands before its first rows, so a run that is cut off can go on
            ensure_table(spark, table, landed.schema, partition_by=["folder"])
            schema = T.StructType([f for f in landed.schema if f.name != "folder"])
        # in place of what a run that was cut off has left of these folders
        overwrite_partitions(landed.select(*[field(f.name) for f in schema], "folder"), table)
        part.write.mode("append").insertInto(quoted(ledger))
    return count


def _described(df, partition_by: Sequence[str]) -> list[tuple]:
    fields = [(f.name, f.dataType.simpleString(), f.metadata.get("comment")) for f in df.schema]
    last = [f[:2] for f in fields if f[0] in partition_by]
    return [f for f in fields if f[0] not in partition_by] + last
