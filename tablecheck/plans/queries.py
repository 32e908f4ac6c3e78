"""Registered queries, each with the SQL that an independent engine runs for it.

All of them read the given tables whole. Inputs the tables lack, such as NULLs,
repeated keys or a key that holds a third of the rows, are derived from them in
the query and in its SQL alike. Arrays are emitted as joined text and missing
values as ``-``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.functions import (
    column_id,
    mark_missing,
    normalize_missing,
    parse_properties,
    same_text,
    table_id,
)
from tablecheck.operators import layout, quality, registry, rowchange, rules
from tablecheck.plans import batch
from tablecheck.sources import dictionary as shapes
from tablecheck.sources import folders, landing
from tablecheck.sources.scratch import scratch_path
from tablecheck.sources.tables import add_columns, append_rows, ensure_table, load, local_rows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem "
    "events documents embeddings pages benchmark labels conversations"
).split()


def query(oracle: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = oracle
        return run

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, f"{sf_dir}/{name}.parquet")


def tags_text() -> Column:
    return F.coalesce(F.array_join(quality.TAG, ","), F.lit("untested")).alias("tags")


def text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("-")).alias(name)


# ---------------------------------------------------------------- row tests

EVENT_KEY = ["user_id", "hour"]
EVENT_RULES = [
    rules.Rule("lake.events.event_type.is_null", "event_type"),
    rules.Rule("lake.events.event_type.is_not_length_5", "event_type", 5),
]

# one row per event; several events of a user can fall in one hour
EVENT_SQL = """
    SELECT user_id, strftime(ts, '%Y-%m-%d %H') AS hour,
           nullif(event_type, 'click') AS event_type
    FROM events"""

EVENT_FAILED_SQL = """concat_ws(',',
        CASE WHEN event_type IS NULL THEN 'lake.events.event_type.is_null' END,
        CASE WHEN length(event_type) <> 5 THEN 'lake.events.event_type.is_not_length_5' END)"""


def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        "user_id",
        F.substring(F.col("ts").cast("string"), 1, 13).alias("hour"),
        F.nullif("event_type", F.lit("click")).alias("event_type"),
    )


@query(f"""
    WITH fact AS ({EVENT_SQL}),
    grouped AS (
        SELECT user_id, hour, count(*) AS n, max({EVENT_FAILED_SQL}) AS failed
        FROM fact GROUP BY user_id, hour)
    SELECT user_id, hour, CASE WHEN n = 1 THEN failed ELSE 'key_not_unique' END AS tags
    FROM grouped
""")
def tag_keys_events(spark, sf_dir):
    tagged = quality.tag_keys(event_fact(spark, sf_dir), EVENT_RULES, EVENT_KEY)
    return tagged.select(*EVENT_KEY, tags_text())


@query(f"""
    SELECT user_id, hour, {EVENT_FAILED_SQL} AS tags FROM ({EVENT_SQL})
""")
def tag_rows_events(spark, sf_dir):
    tagged = quality.tag_rows(event_fact(spark, sf_dir), EVENT_RULES, EVENT_KEY)
    return tagged.select(*EVENT_KEY, tags_text())


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS key_count
    FROM lineitem GROUP BY l_orderkey, l_linenumber
""")
def key_unique_composite(spark, sf_dir):
    return quality.key_counts(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    WITH fact AS (
        SELECT nullif(o_orderstatus, 'P') AS status, o_custkey, o_orderpriority FROM orders),
    grouped AS (
        SELECT status, o_custkey, count(*) AS n,
               max(CASE WHEN length(o_orderpriority) <> 5
                        THEN 'lake.orders.o_orderpriority.is_not_length_5' ELSE '' END) AS failed
        FROM fact GROUP BY status, o_custkey)
    SELECT coalesce(status, '-') AS status, o_custkey,
           CASE WHEN n > 1 OR status IS NULL THEN 'key_not_unique' ELSE failed END AS tags
    FROM grouped
""")
def tag_null_keys(spark, sf_dir):
    fact = read(spark, sf_dir, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_custkey", "o_orderpriority"
    )
    found = [
        rules.Rule("lake.orders.o_orderpriority.is_not_length_5", "o_orderpriority", 5)
    ]
    return quality.tag_keys(fact, found, ["status", "o_custkey"]).select(
        text("status"), "o_custkey", tags_text()
    )


_LENGTHS = range(1, 71)


@query(
    "SELECT p_partkey, concat_ws(',', "
    + ", ".join(
        f"CASE WHEN length(p_name) <> {n} THEN 'lake.part.p_name.is_not_length_{n}' END"
        for n in _LENGTHS
    )
    + ") AS tags FROM part"
)
def tag_keys_many_rules(spark, sf_dir):
    found = [
        rules.Rule(f"lake.part.p_name.is_not_length_{n}", "p_name", n) for n in _LENGTHS
    ]
    tagged = quality.tag_keys(read(spark, sf_dir, "part"), found, ["p_partkey"])
    return tagged.select("p_partkey", tags_text())


DOCUMENT_RULES = [
    rules.Rule("lake.documents.lang.is_null", "lang"),
    rules.Rule("lake.documents.source.is_not_length_4", "source", 4),
]


@query("""
    SELECT doc_id,
           CASE WHEN count(*) OVER (PARTITION BY text) > 1 THEN 'key_not_unique'
                ELSE concat_ws(',',
                    CASE WHEN nullif(lang, 'fr') IS NULL THEN 'lake.documents.lang.is_null' END,
                    CASE WHEN length(source) <> 4
                         THEN 'lake.documents.source.is_not_length_4' END)
           END AS tags
    FROM documents
""")
def with_tags_documents(spark, sf_dir):
    fact = read(spark, sf_dir, "documents").withColumn("lang", F.nullif("lang", F.lit("fr")))
    return quality.with_tags(fact, DOCUMENT_RULES, ["text"]).select("doc_id", tags_text())


# a third of the orders share one key, another part has none
HOT_SQL = """
    SELECT CASE WHEN o_orderstatus = 'F' THEN -1
                WHEN o_orderpriority = '2-HIGH' THEN NULL
                ELSE o_orderkey END AS id,
           o_orderstatus, o_orderpriority, o_totalprice
    FROM orders"""


def hot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (
        F.when(F.col("o_orderstatus") == "F", F.lit(-1).cast("bigint"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit(None))
        .otherwise(F.col("o_orderkey"))
    )
    return read(spark, sf_dir, "orders").select(
        key.alias("id"), "o_orderstatus", "o_orderpriority", "o_totalprice"
    )


HOT_RULES = [rules.Rule("priority.is_not_length_5", "o_orderpriority", 5)]


@query(f"""
    WITH fact AS ({HOT_SQL})
    SELECT coalesce(CAST(id AS VARCHAR), '-') AS id, o_orderpriority, o_totalprice,
           CASE WHEN id IS NULL OR count(*) OVER (PARTITION BY id) > 1 THEN 'key_not_unique'
                WHEN length(o_orderpriority) <> 5 THEN 'priority.is_not_length_5'
                ELSE '' END AS tags
    FROM fact
""")
def with_tags_hot_key(spark, sf_dir):
    fact = hot_orders(spark, sf_dir)
    tagged = quality.with_tags(fact, HOT_RULES, ["id"])
    return tagged.select(text("id"), "o_orderpriority", "o_totalprice", tags_text())


# ---------------------------------------------------------------- quality tables


@query(f"""
    WITH fact AS (
        SELECT user_id, nullif(event_type, 'click') AS kind, ts FROM events),
    earlier AS (
        SELECT user_id, kind FROM fact WHERE ts < TIMESTAMP '2024-01-03 00:00:00'),
    seeded AS (
        SELECT user_id, kind, 'old' AS tags FROM earlier
        UNION ALL
        SELECT user_id, kind, 'untested' FROM fact f
        WHERE NOT EXISTS (SELECT 1 FROM earlier e
                          WHERE e.user_id = f.user_id AND e.kind IS NOT DISTINCT FROM f.kind))
    SELECT user_id, coalesce(kind, '-') AS kind, tags, count(*) AS n
    FROM seeded GROUP BY 1, 2, 3
""")
def seed_quality(spark, sf_dir):
    fact = read(spark, sf_dir, "events").select(
        "user_id", F.nullif("event_type", F.lit("click")).alias("kind"), "ts"
    )
    known = fact.where(F.col("ts") < F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")).select(
        "user_id", "kind", F.array(F.lit("old")).alias(quality.TAG)
    )
    keys = ["user_id", "kind"]
    once = quality.seed_quality(fact, known, keys)
    twice = quality.seed_quality(fact, once, keys)
    return (
        twice.select("user_id", text("kind"), tags_text())
        .groupBy("user_id", "kind", "tags")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(f"""
    WITH fact AS (SELECT id FROM ({HOT_SQL})),
    known AS (SELECT l_orderkey AS id FROM lineitem)
    SELECT coalesce(CAST(id AS VARCHAR), '-') AS id, tags, count(*) AS n
    FROM (SELECT id, 'old' AS tags FROM known
          UNION ALL
          SELECT id, 'untested' FROM fact
          WHERE id IS NULL OR id NOT IN (SELECT id FROM known))
    GROUP BY 1, 2
""")
def seed_quality_hot_key(spark, sf_dir):
    known = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.array(F.lit("old")).alias(quality.TAG)
    )
    seeded = quality.seed_quality(hot_orders(spark, sf_dir), known, ["id"])
    return (
        seeded.select(text("id"), tags_text())
        .groupBy("id", "tags")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(f"""
    WITH fact AS ({EVENT_SQL}),
    later AS (SELECT * FROM fact WHERE hour >= '2024-01-03 00'),
    quality AS (SELECT user_id, nullif(hour, '2024-01-02 00') AS hour FROM fact),
    tags AS (
        SELECT user_id, hour,
               CASE WHEN count(*) = 1 THEN max({EVENT_FAILED_SQL})
                    ELSE 'key_not_unique' END AS tags
        FROM later GROUP BY user_id, hour)
    SELECT q.user_id, coalesce(q.hour, '-') AS hour,
           CASE WHEN q.hour IS NULL THEN 'key_not_unique' ELSE coalesce(t.tags, 'old') END AS tags
    FROM quality q LEFT JOIN tags t ON q.user_id = t.user_id AND q.hour = t.hour
""")
def apply_tags_events(spark, sf_dir):
    fact = event_fact(spark, sf_dir)
    known = fact.select(
        "user_id",
        F.nullif("hour", F.lit("2024-01-02 00")).alias("hour"),
        F.array(F.lit("old")).alias(quality.TAG),
    )
    tags = quality.tag_keys(fact.where(F.col("hour") >= "2024-01-03 00"), EVENT_RULES, EVENT_KEY)
    return quality.apply_tags(known, tags, EVENT_KEY).select("user_id", text("hour"), tags_text())


@query(f"""
    WITH fact AS ({HOT_SQL}),
    tags AS (
        SELECT id, CASE WHEN count(*) > 1 THEN 'key_not_unique'
                        WHEN max(length(o_orderpriority)) <> 5 THEN 'priority.is_not_length_5'
                        ELSE '' END AS tags
        FROM fact WHERE id IS NOT NULL GROUP BY id)
    SELECT coalesce(CAST(f.id AS VARCHAR), '-') AS id, f.o_totalprice,
           coalesce(t.tags, 'key_not_unique') AS tags
    FROM fact f LEFT JOIN tags t ON f.id = t.id
""")
def apply_tags_hot_key(spark, sf_dir):
    fact = hot_orders(spark, sf_dir)
    known = fact.select(
        "id", "o_totalprice", F.lit(None).cast("array<string>").alias(quality.TAG)
    )
    tags = quality.tag_keys(fact, HOT_RULES, ["id"])
    done = quality.apply_tags(known, tags, ["id"])
    return done.select(text("id"), "o_totalprice", tags_text())


@query(f"""
    WITH fact AS ({EVENT_SQL}),
    quality AS (
        SELECT user_id, hour FROM fact WHERE event_type = 'purchase'
        UNION ALL
        SELECT c_custkey, c_mktsegment FROM customer),
    tags AS (
        SELECT user_id, hour,
               CASE WHEN count(*) = 1 THEN max({EVENT_FAILED_SQL})
                    ELSE 'key_not_unique' END AS tags
        FROM fact GROUP BY user_id, hour),
    rows AS (
        SELECT q.user_id, q.hour, coalesce(t.tags, 'old') AS tags
        FROM quality q LEFT JOIN tags t ON q.user_id = t.user_id AND q.hour = t.hour
        UNION ALL
        SELECT f.user_id, f.hour, t.tags
        FROM fact f JOIN tags t ON f.user_id = t.user_id AND f.hour = t.hour
        WHERE NOT EXISTS (SELECT 1 FROM quality q
                          WHERE q.user_id = f.user_id AND q.hour = f.hour))
    SELECT user_id, hour, tags, count(*) AS n FROM rows GROUP BY 1, 2, 3
""")
def refresh_quality_events(spark, sf_dir):
    fact = event_fact(spark, sf_dir)
    # keys of an earlier run, among them some that the fact does not have
    known = (
        fact.where(F.col("event_type") == "purchase")
        .select(*EVENT_KEY)
        .union(read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))
        .withColumn(quality.TAG, F.array(F.lit("old")))
    )
    done = quality.refresh_quality(fact, known, EVENT_RULES, EVENT_KEY)
    return (
        done.select(*EVENT_KEY, tags_text())
        .groupBy(*EVENT_KEY, "tags")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# ---------------------------------------------------------------- row changes

# the orders under new numbers: some numbers are known, the others are new
RENUMBERED_SQL = """
    SELECT o_orderkey * 2 AS id, o_custkey * 2 AS customer, o_totalprice + 1 AS price FROM orders"""


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        (F.col("o_orderstatus") == "P").alias("is_deleted"),
    )


def renumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") * 2).alias("id"),
        (F.col("o_custkey") * 2).alias("customer"),
        (F.col("o_totalprice") + 1).alias("price"),
    )


@query(f"""
    WITH source AS ({RENUMBERED_SQL})
    SELECT coalesce(o.o_orderkey, s.id) AS id,
           coalesce(o.o_custkey, s.customer) AS customer,
           CASE WHEN o.o_orderkey IS NULL THEN 'new'
                WHEN s.id IS NULL THEN o.o_orderstatus
                ELSE o.o_orderstatus || '+' END AS status,
           CASE WHEN s.id IS NULL THEN o.o_totalprice ELSE s.price END AS price
    FROM orders o FULL JOIN source s ON o.o_orderkey = s.id
""")
def merge_upsert_orders(spark, sf_dir):
    return rowchange.merge(
        order_rows(spark, sf_dir).drop("is_deleted"),
        renumbered(spark, sf_dir),
        ["id"],
        matched={"price": "price", "status": F.concat("t.status", F.lit("+"))},
        not_matched={
            "id": "id",
            "customer": "customer",
            "price": "price",
            "status": F.lit("new"),
        },
    )


@query("""
    WITH target AS (
        SELECT CASE WHEN l_returnflag = 'R' THEN -1
                    WHEN l_linestatus = 'O' THEN NULL ELSE l_orderkey END AS id,
               l_quantity AS quantity
        FROM lineitem),
    source AS (
        SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
                    WHEN o_orderstatus = 'O' THEN -2
                    WHEN o_orderkey = 1 THEN -1
                    ELSE o_orderkey * 3 END AS id, o_totalprice AS price
        FROM orders),
    rows AS (
        SELECT t.id, CASE WHEN s.id IS NULL THEN t.quantity ELSE s.price END AS quantity
        FROM target t LEFT JOIN source s ON t.id = s.id
        UNION ALL
        SELECT s.id, s.price FROM source s
        WHERE s.id IS NULL OR s.id NOT IN (SELECT id FROM target WHERE id IS NOT NULL))
    SELECT coalesce(CAST(id AS VARCHAR), '-') AS id, quantity, count(*) AS n
    FROM rows GROUP BY 1, 2
""")
def merge_upsert_hot_keys(spark, sf_dir):
    # frequent keys on both sides, among them NULL and a repeated new key
    target = read(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", F.lit(-1).cast("bigint"))
        .when(F.col("l_linestatus") == "O", F.lit(None))
        .otherwise(F.col("l_orderkey"))
        .alias("id"),
        F.col("l_quantity").alias("quantity"),
    )
    source = read(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast("bigint"))
        .when(F.col("o_orderstatus") == "O", F.lit(-2))
        .when(F.col("o_orderkey") == 1, F.lit(-1))
        .otherwise(F.col("o_orderkey") * 3)
        .alias("id"),
        F.col("o_totalprice").alias("price"),
    )
    merged = rowchange.merge(
        target,
        source,
        ["id"],
        matched={"quantity": "price"},
        not_matched={"id": "id", "quantity": "price"},
        split_hot=True,
    )
    return (
        merged.select(text("id"), "quantity")
        .groupBy("id", "quantity")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("""
    SELECT d.doc_id,
           CASE WHEN l.doc_id IS NULL THEN d.n_chars ELSE l.quality END AS quality,
           CAST(CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS toxic,
           CASE WHEN l.doc_id IS NULL THEN '-' ELSE 'checked' END AS note
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def merge_insert_star(spark, sf_dir):
    # the target has a column the source lacks
    target = read(spark, sf_dir, "labels").select(
        "doc_id",
        F.col("quality").cast("bigint").alias("quality"),
        F.col("toxic").cast("bigint").alias("toxic"),
        F.lit("checked").alias("note"),
    )
    source = read(spark, sf_dir, "documents").select(
        "doc_id", F.col("n_chars").alias("quality"), F.lit(0).cast("bigint").alias("toxic")
    )
    merged = rowchange.merge(
        target, source, ["doc_id"], matched={"toxic": F.lit(1)}, not_matched="*"
    )
    return merged.select("doc_id", "quality", "toxic", text("note"))


@query("""
    SELECT o.o_orderkey, coalesce(s.price, o.o_totalprice) AS o_totalprice
    FROM orders o
    LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS price FROM lineitem
               GROUP BY l_orderkey) s
      ON o.o_orderkey = s.l_orderkey
""")
def merge_matched_only(spark, sf_dir):
    source = (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_extendedprice").alias("price"))
    )
    target = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return rowchange.merge(
        target, source, {"o_orderkey": "l_orderkey"}, matched={"o_totalprice": "price"}
    )


@query("""
    SELECT user_id, event_type, value FROM events
    UNION ALL
    SELECT c_custkey, 'none', c_acctbal FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events)
""")
def merge_insert_only(spark, sf_dir):
    return rowchange.merge(
        read(spark, sf_dir, "events").select("user_id", "event_type", "value"),
        read(spark, sf_dir, "customer"),
        {"user_id": "c_custkey"},
        not_matched={"user_id": "c_custkey", "event_type": F.lit("none"), "value": "c_acctbal"},
    )


@query("""
    SELECT p_partkey,
           CASE WHEN nullif(p_brand, 'Brand#4') IN ('Brand#4', 'Brand#2', 'Brand#19')
                THEN p_retailprice * 2 ELSE p_retailprice END AS p_retailprice,
           CASE WHEN nullif(p_brand, 'Brand#4') IN ('Brand#4', 'Brand#2', 'Brand#19')
                THEN upper(p_name) ELSE p_name END AS p_name
    FROM part
""")
def update_where_part(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_name", "p_brand")
    brand = F.nullif("p_brand", F.lit("Brand#4"))
    return rowchange.update_where(
        part,
        brand.isin("Brand#4", "Brand#2", "Brand#19"),
        {"p_retailprice": F.col("p_retailprice") * 2, "p_name": F.upper("p_name")},
    ).drop("p_brand")


@query("""
    SELECT o_orderkey, o_orderstatus,
           o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
               AND o_orderstatus IN (SELECT l_linestatus FROM lineitem) AS is_deleted
    FROM orders
""")
def soft_delete_scoped(spark, sf_dir):
    target = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.lit(False).alias("is_deleted")
    )
    return rowchange.soft_delete(
        target,
        read(spark, sf_dir, "lineitem"),
        {"o_orderkey": "l_orderkey"},
        scope={"o_orderstatus": "l_linestatus"},
    )


@query("""
    SELECT o_orderkey, o_custkey,
           NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS is_deleted
    FROM orders o
""")
def soft_delete_unscoped(spark, sf_dir):
    target = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.lit(False).alias("is_deleted")
    )
    return rowchange.soft_delete(
        target, read(spark, sf_dir, "lineitem"), {"o_orderkey": "l_orderkey"}
    )


SYNC_ORACLE = f"""
    WITH source AS ({RENUMBERED_SQL})
    SELECT coalesce(o.o_orderkey, s.id) AS id,
           coalesce(o.o_custkey, s.customer) AS customer,
           coalesce(o.o_orderstatus, '-') AS status,
           CASE WHEN s.id IS NULL THEN o.o_totalprice ELSE s.price END AS price,
           CASE WHEN s.id IS NOT NULL THEN false
                WHEN o.o_custkey IN (SELECT customer FROM source) THEN true
                ELSE o.o_orderstatus = 'P' END AS is_deleted
    FROM orders o FULL JOIN source s ON o.o_orderkey = s.id
"""


def _sync(spark, sf_dir, split_hot):
    done = rowchange.sync(
        order_rows(spark, sf_dir),
        renumbered(spark, sf_dir),
        ["id"],
        matched={"price": "price"},
        scope=["customer"],
        split_hot=split_hot,
    )
    return done.select("id", "customer", text("status"), "price", "is_deleted")


@query(SYNC_ORACLE)
def sync_reactivate(spark, sf_dir):
    return _sync(spark, sf_dir, None)


@query("""
    WITH target AS (
        SELECT CASE WHEN o_orderstatus = 'F' THEN -1
                    WHEN o_orderpriority = '2-HIGH' THEN NULL
                    ELSE o_orderkey END AS id, o_orderstatus AS status, o_totalprice AS price
        FROM orders),
    source AS (SELECT DISTINCT l_orderkey * 2 AS id FROM lineitem),
    rows AS (
        SELECT t.id, t.status, t.price, s.id IS NULL AND t.id IS NOT NULL AS is_deleted
        FROM target t LEFT JOIN source s ON t.id = s.id
        UNION ALL
        SELECT id, NULL, NULL, false FROM source
        WHERE id NOT IN (SELECT id FROM target WHERE id IS NOT NULL))
    SELECT coalesce(CAST(id AS VARCHAR), '-') AS id, coalesce(status, '-') AS status,
           coalesce(price, 0) AS price, is_deleted
    FROM rows
""")
def sync_hot_key(spark, sf_dir):
    target = hot_orders(spark, sf_dir).select(
        "id",
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        F.lit(False).alias("is_deleted"),
    )
    source = read(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 2).alias("id"))
    done = rowchange.sync(target, source.distinct(), ["id"], matched={})
    return done.select(
        text("id"), text("status"), F.coalesce("price", F.lit(0.0)).alias("price"), "is_deleted"
    )


# ---------------------------------------------------------------- dictionary and rules

DICTIONARY_TABLES = ("events", "orders", "lineitem", "documents")


def landed(spark: SparkSession, sf_dir: str, tables) -> DataFrame:
    return landing._union(
        [landing.land_columns(read(spark, sf_dir, t), "lake", t) for t in tables]
    )


def _columns_sql(tables: dict[str, dict[str, str]], counts: bool = True) -> str:
    """One SELECT per column: table, name, ordinal, type and counted NULLs."""
    parts = []
    for table, columns in tables.items():
        for ordinal, (name, kind) in enumerate(columns.items(), start=1):
            parts.append(
                f"SELECT 'lake' AS database, '{table}' AS \"table\", '{name}' AS column_name, "
                f"CAST({ordinal} AS BIGINT) AS ordinal, '{kind}' AS data_type, "
                f"count(*) - count({name}) AS null_count FROM {table}"
            )
    return "\nUNION ALL ".join(parts)


# Columns and Spark types of the given tables, in file order.
GIVEN_COLUMNS = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {
        "c_custkey": "bigint",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    "supplier": {
        "s_suppkey": "bigint",
        "s_name": "string",
        "s_nationkey": "int",
        "s_acctbal": "double",
    },
    "part": {
        "p_partkey": "bigint",
        "p_name": "string",
        "p_brand": "string",
        "p_type": "string",
        "p_size": "int",
        "p_retailprice": "double",
    },
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_extendedprice": "double",
        "l_discount": "double",
        "l_tax": "double",
        "l_returnflag": "string",
        "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
    "events": {
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    },
    "documents": {
        "doc_id": "bigint",
        "text": "string",
        "lang": "string",
        "source": "string",
        "n_chars": "bigint",
    },
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {
        "conv_id": "bigint",
        "turn": "bigint",
        "role": "string",
        "text": "string",
    },
}


@query("""
    SELECT 'lake.events.event_type' AS column_id, 'lake.events' AS table_id,
           'event_type' AS column_name, 'string' AS data_type,
           CAST(4 AS BIGINT) AS ordinal, true AS nullable,
           count(*) - count(nullif(event_type, 'click')) AS null_count FROM events
    UNION ALL
    SELECT 'lake.events.value', 'lake.events', 'value', 'double', 5, true,
           count(*) - count(CASE WHEN value >= 10 THEN value END) FROM events
""" + "".join(
    f"""
    UNION ALL
    SELECT 'lake.{table}.{name}', 'lake.{table}', '{name}', '{kind}', {ordinal}, true,
           count(*) - count({name}) FROM {table}"""
    for table in ("events", "orders")
    for ordinal, (name, kind) in enumerate(GIVEN_COLUMNS[table].items(), start=1)
    if name not in ("event_type", "value")
))
def land_columns(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumns(
        {
            "event_type": F.nullif("event_type", F.lit("click")),
            "value": F.when(F.col("value") >= 10, F.col("value")),
        }
    )
    both = landing.land_columns(events, "lake", "events").unionByName(
        landing.land_columns(read(spark, sf_dir, "orders"), "lake", "orders")
    )
    return both.select(
        "column_id",
        "table_id",
        F.col("columnName").alias("column_name"),
        F.col("dataType").alias("data_type"),
        F.col("ordinalPosition").cast("bigint").alias("ordinal"),
        "nullable",
        "null_count",
    )


@query(_columns_sql(GIVEN_COLUMNS))
def land_columns_footers(spark, sf_dir):
    # NULLs of all columns but the nested ones come from the files' footers
    found = landing._union(
        [landing.land_file_columns(spark, f"{sf_dir}/{t}.parquet", "lake", t) for t in TABLES]
    )
    return found.select(
        "database",
        "table",
        F.col("columnName").alias("column_name"),
        F.col("ordinalPosition").cast("bigint").alias("ordinal"),
        F.col("dataType").alias("data_type"),
        "null_count",
    )


@query("\nUNION ALL ".join(
    f"SELECT 'lake' AS database, '{t}' AS \"table\", count(*) AS records, "
    f"CAST(1 AS BIGINT) AS objects, 'parquet' AS classification, false AS is_view, "
    f"true AS is_sized FROM {t}"
    for t in TABLES
))
def land_table_stats(spark, sf_dir):
    facts = landing.land_tables(
        spark, {("lake", t): f"{sf_dir}/{t}.parquet" for t in TABLES}
    )
    return facts.select(
        "database",
        "table",
        F.col("recordCount").alias("records"),
        F.col("objectCount").alias("objects"),
        "classification",
        "is_view",
        (F.col("sizeKey") > F.col("recordCount")).alias("is_sized"),
    )


# Tables whose files hold a line of text for each row, so that their size is known.
LINES = {
    "orders": ("o_orderkey", "o_orderstatus"),
    "events": ("event_id", "event_type"),
    "customer": ("c_custkey", "c_name"),
    "documents": ("doc_id", "lang"),
}


@query("\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS records, CAST(2 AS BIGINT) AS objects, "
    f"CAST(sum(strlen(concat_ws(',', {a}, {b})) + 1) AS BIGINT) AS size, "
    f"CAST(sum(strlen(concat_ws(',', {a}, {b})) + 1) // count(*) AS BIGINT) AS avg_size, "
    f"'a, [b]=c' AS delimiter, 'text' AS classification FROM {t}"
    for t, (a, b) in LINES.items()
) + """
    UNION ALL SELECT 'seen', 0, 0, 0, 0, '-', '-'
    UNION ALL SELECT 'gone', 0, 0, 0, 0, '-', 'text'
""")
def land_catalog_facts(spark, sf_dir):
    # each table is a file with all rows and one without; another one has lost its folder
    lake = _database(spark, "facts")
    for table, columns in LINES.items():
        lines = read(spark, sf_dir, table).select(F.concat_ws(",", *columns).alias("value"))
        name = f"{lake}.{table}"
        spark.sql(f"CREATE TABLE {name} (value STRING) USING text TBLPROPERTIES ('delimiter' = 'a, [b]=c')")
        for part in (lines, lines.where("false")):
            part.coalesce(1).write.mode("append").format("text").insertInto(name)
    spark.sql(f"CREATE TABLE {lake}.gone (value STRING) USING text LOCATION '{scratch_path(spark, 'gone')}'")
    spark.sql(f"CREATE VIEW {lake}.seen AS SELECT 1 AS one")
    return landing.land_database_tables(spark, [lake]).select(
        "table",
        F.col("recordCount").alias("records"),
        F.col("objectCount").alias("objects"),
        F.col("sizeKey").alias("size"),
        F.col("avgRecordSize").alias("avg_size"),
        text("delimiter"),
        text("classification"),
    )


@query("""
    SELECT c_custkey, c_name AS a, ',' AS delimiter, 'x=' || c_mktsegment AS b FROM customer
""")
def parse_properties_customer(spark, sf_dir):
    joined = F.concat(
        F.lit("[a="), "c_name", F.lit(",delimiter=,,b=x="), "c_mktsegment", F.lit("]")
    )
    parsed = parse_properties(joined)
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        parsed["a"].alias("a"),
        parsed["delimiter"].alias("delimiter"),
        parsed["b"].alias("b"),
    )


@query("""
    WITH creates AS (
        SELECT o_custkey, max(o_orderkey) AS last, count(*) AS n FROM orders GROUP BY o_custkey)
    SELECT c_mktsegment || '.' || c_name AS table_id,
           c_mktsegment AS database, c_name AS "table",
           CASE c_mktsegment WHEN 'FURNITURE' THEN '-' WHEN 'HOUSEHOLD' THEN 'none'
                             ELSE c_mktsegment END AS description,
           'CREATE ' || CAST(last AS VARCHAR) AS create_statement,
           CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'false' ELSE '-' END
               AS are_columns_quoted,
           CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN '-' ELSE c_mktsegment END
               AS classification,
           n AS record_count,
           coalesce(CAST(TRY_CAST(CASE WHEN c_acctbal < 0 THEN 'text'
                                       ELSE CAST(c_nationkey AS VARCHAR) END AS BIGINT)
                         AS VARCHAR), '-') AS size_key,
           false AS is_deleted
    FROM customer JOIN creates ON c_custkey = o_custkey
""")
def stage_table_metadata(spark, sf_dir):
    marker = (
        F.when(F.col("c_mktsegment") == "FURNITURE", "None")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "none")
        .otherwise(F.col("c_mktsegment"))
    )
    orders = read(spark, sf_dir, "orders")
    customers = read(spark, sf_dir, "customer")
    counted = orders.groupBy("o_custkey").agg(
        F.max("o_orderkey").alias("last"), F.count(F.lit(1)).alias("n")
    )
    named = customers.join(counted, customers.c_custkey == counted.o_custkey)
    facts = named.select(
        F.col("c_mktsegment").alias("database"),
        F.col("c_name").alias("table"),
        marker.alias("description"),
        marker.alias("areColumnsQuoted"),
        marker.alias("columnsOrdered"),
        marker.alias("classification"),
        marker.alias("compressionType"),
        marker.alias("delimiter"),
        F.lit("crawler").alias("updateCrawler"),
        F.lit("1").alias("objectCount"),
        F.col("n").cast("string").alias("recordCount"),
        F.when(F.col("c_acctbal") < 0, "text")
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("sizeKey"),
        F.lit("0").alias("skipLine"),
        F.lit("file").alias("typeData"),
        F.lit("/lake").alias("location"),
        F.lit(False).alias("is_view"),
    )
    creates = named.select(
        F.col("c_mktsegment").alias("database"),
        F.col("c_name").alias("table"),
        F.concat(F.lit("CREATE "), F.col("last").cast("string")).alias("createStatement"),
    )
    staged = landing.stage_table_metadata(facts, creates)
    return staged.select(
        "table_id",
        "database",
        "table",
        text("description"),
        "create_statement",
        text("are_columns_quoted"),
        text("classification"),
        "record_count",
        text("size_key"),
        "is_deleted",
    )


@query("""
    SELECT c_custkey, c_custkey AS number,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '-' ELSE c_mktsegment END AS cleaned,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'None' ELSE c_mktsegment END AS marked,
           CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS balance
    FROM customer
""")
def missing_markers_customer(spark, sf_dir):
    segment = F.col("c_mktsegment")
    base = read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_custkey").alias("number"),
        F.when(segment == "BUILDING", "None").otherwise(segment).alias("cleaned"),
        F.nullif(segment, F.lit("BUILDING")).alias("marked"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )
    cleaned = normalize_missing(base, {"cleaned": ["None", "none"]}, {"balance": 0})
    return mark_missing(cleaned.drop("cleaned")).join(
        cleaned.select("c_custkey", text("cleaned")), "c_custkey"
    )


@query("""
    WITH landed AS (""" + _columns_sql({t: GIVEN_COLUMNS[t] for t in DICTIONARY_TABLES}) + """),
    wide AS (SELECT *, database || '.' || "table" || '.' || column_name AS column_id FROM landed)
    SELECT database, "table", column_name, column_id || '.is_null' AS test_name
    FROM wide WHERE null_count = 0 AND data_type = 'bigint'
    UNION ALL
    SELECT database, "table", column_name, column_id || '.is_not_length_5'
    FROM wide WHERE column_name IN ('event_type', 'o_orderpriority', 'source')
""")
def rules_from_dictionary(spark, sf_dir):
    found = landed(spark, sf_dir, DICTIONARY_TABLES)
    empty = local_rows(spark, [], shapes.COLUMN_DICTIONARY)
    columns = add_columns(landing.sync_columns(empty, found), shapes.COLUMN_RULES)
    # bigint columns found free of NULLs are to stay so
    keys = found.where((F.col("null_count") == 0) & (F.col("dataType") == "bigint"))
    columns = rowchange.merge(
        columns,
        keys,
        {"column_id": "column_id"},
        matched={"null_test": F.lit(True)},
        source_unique=True,
    )
    columns = rules.set_length_test(columns, ["event_type", "o_orderpriority", "source"], 5)
    names = ["database", "table", "column_name", "test_name"]
    return (
        rules.null_rules(columns).select(*names).unionByName(
            rules.length_rules(columns).select(*names)
        )
    )


@query("""
    SELECT coalesce(database, '-') AS database, coalesce("table", '-') AS "table",
           coalesce(column_name, '-') AS column_name, test_name
    FROM (
        SELECT o_orderstatus AS database, o_orderpriority AS "table",
               CAST(o_custkey AS VARCHAR) AS column_name,
               CAST(o_custkey AS VARCHAR) || '.is_null' AS test_name FROM orders
        UNION
        SELECT l_returnflag, l_linestatus, CAST(l_partkey AS VARCHAR),
               CAST(l_partkey AS VARCHAR) || '.is_not_length_' || CAST(l_linenumber AS VARCHAR)
        FROM lineitem
        UNION
        SELECT NULL, NULL, NULL, 'key_not_unique')
""")
def triage_union(spark, sf_dir):
    customer, part = F.col("o_custkey").cast("string"), F.col("l_partkey").cast("string")
    nulls = read(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("database"),
        F.col("o_orderpriority").alias("table"),
        customer.alias("column_name"),
        F.concat(customer, F.lit(".is_null")).alias("test_name"),
    )
    lengths = read(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("database"),
        F.col("l_linestatus").alias("table"),
        part.alias("column_name"),
        F.concat(part, F.lit(".is_not_length_"), "l_linenumber").alias("test_name"),
    )
    return registry.triage_rules(nulls, lengths).select(
        text("database"), text("table"), text("column_name"), "test_name"
    )


@query("""
    WITH known AS (
        SELECT 'r.' || CAST(p_partkey AS VARCHAR) AS test_name, p_brand AS database,
               p_size > 25 AS is_block, p_brand = 'Brand#4' AS is_deleted FROM part),
    triage AS (
        SELECT DISTINCT 'r.' || CAST(l_partkey * 2 AS VARCHAR) AS test_name FROM lineitem
        UNION ALL SELECT 'key_not_unique')
    SELECT coalesce(k.test_name, t.test_name) AS test_name,
           CASE WHEN k.test_name IS NOT NULL THEN k.database
                WHEN t.test_name = 'key_not_unique' THEN '-' ELSE 'lake' END AS database,
           coalesce(k.is_block, false) AS is_block,
           t.test_name IS NULL AS is_deleted
    FROM known k FULL JOIN triage t ON k.test_name = t.test_name
""")
def registry_sync(spark, sf_dir):
    known = read(spark, sf_dir, "part").select(
        F.col("p_brand").alias("database"),
        F.col("p_type").alias("table"),
        F.col("p_name").alias("column_name"),
        F.concat(F.lit("r."), F.col("p_partkey").cast("string")).alias("test_name"),
        (F.col("p_size") > 25).alias("is_block"),
        (F.col("p_brand") == "Brand#4").alias("is_deleted"),
    )
    names = read(spark, sf_dir, "lineitem").select(
        F.lit("lake").alias("database"),
        F.lit("lineitem").alias("table"),
        F.lit("l_partkey").alias("column_name"),
        F.concat(F.lit("r."), (F.col("l_partkey") * 2).cast("string")).alias("test_name"),
    )
    # every name is listed many times; the triage set holds it once
    triage = registry.triage_rules(names, names)
    done = registry.sync_registry(known, triage)
    return done.select("test_name", text("database"), "is_block", "is_deleted")


@query("""
    SELECT page_id, 'lake' || '.' || lower(url) AS table_id,
           'lake.' || url || '.html' AS column_id, true AS same
    FROM pages
""")
def derived_ids_pages(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        table_id(F.lit("lake"), F.lower("url")).alias("table_id"),
        column_id(F.lit("lake"), F.col("url"), F.lit("html")).alias("column_id"),
        same_text("url", F.upper("url")).alias("same"),
    )


# ---------------------------------------------------------------- tables and layout


@query("""
    SELECT o_orderkey, '-' AS note, o_custkey, '-' AS checked,
           'o_orderkey,note,o_custkey,checked' AS names
    FROM orders
""")
def add_columns_orders(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    wide = add_columns(orders, {"note": "string", "o_custkey": "int"}, after="o_orderkey")
    wide = add_columns(wide, {"checked": "boolean"})
    return wide.select(
        "o_orderkey",
        text("note"),
        "o_custkey",
        text("checked"),
        F.lit(",".join(wide.columns)).alias("names"),
    )


@query("""
    SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day
    FROM events
    WHERE strftime(ts, '%Y-%m-%d') NOT IN (
        SELECT strftime(ts, '%Y-%m-%d') FROM events GROUP BY 1
        HAVING count(*) > (SELECT count(*) / count(DISTINCT strftime(ts, '%Y-%m-%d'))
                           FROM events))
""")
def land_new_folders(spark, sf_dir):
    # one folder per day; the days with more events than the average were landed before
    events = read(spark, sf_dir, "events").withColumn(
        "day", F.substring(F.col("ts").cast("string"), 1, 10)
    )
    path = scratch_path(spark, "events-by-day")
    events.write.partitionBy("day").parquet(path)
    days = events.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    mean = days.agg(F.avg("n").alias("mean"))
    busy = days.where(F.col("n") > mean.scalar())
    folder_of = folders.new_folders(spark, path, None)
    ledger = folder_of.withColumn("day", F.regexp_extract("folder", "day=(.*)$", 1)).join(
        busy, "day"
    )
    return folders.land_new_folders(spark, path, ledger.select("folder")).select(
        "event_id", "event_type", "value", F.col("day").cast("string").alias("day")
    )


@query("""
    WITH landed AS (""" + _columns_sql(GIVEN_COLUMNS) + """)
    SELECT "table", column_name, null_count,
           row_number() OVER (PARTITION BY "table" ORDER BY column_name) AS ordinal
    FROM landed
""")
def reorder_alphabetically(spark, sf_dir):
    columns = landed(spark, sf_dir, TABLES).select(
        "database",
        "table",
        "table_id",
        F.col("columnName").alias("column_name"),
        F.col("ordinalPosition").alias("ordinal_position"),
        "null_count",
    )
    return layout.reorder_alphabetically(columns, "LAKE").select(
        "table",
        "column_name",
        "null_count",
        F.col("ordinal_position").cast("bigint").alias("ordinal"),
    )


@query("""
    SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice,
           'o_custkey,o_orderdate,o_orderkey,o_orderstatus,o_totalprice' AS names
    FROM orders
""")
def apply_layout(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    empty = local_rows(spark, [], shapes.COLUMN_DICTIONARY)
    found = landing.land_columns(orders, "lake", "orders", measure=False)
    columns = landing.sync_columns(empty, found)
    columns = layout.reorder_alphabetically(columns, "lake")
    columns = rowchange.update_where(
        columns, F.col("column_name") == "o_orderpriority", {"is_deleted": True}
    )
    facts = landing.land_tables(spark, {("lake", "orders"): orders})
    laid_out = layout.apply_layout(
        orders, columns, facts.withColumn("is_deleted", F.lit(False)), "lake", "orders"
    )
    return laid_out.withColumn("names", F.lit(",".join(laid_out.columns)))


# ---------------------------------------------------------------- whole runs over catalog tables


# Catalog tables: format, partition column, key column.
LAID_OUT = {
    "events": ("parquet", None, "event_id"),
    "orders": ("orc", "o_orderpriority", "o_orderkey"),
    "customer": ("json", None, "c_custkey"),
    "lineitem": ("parquet", "l_returnflag", "l_orderkey"),
    "documents": ("parquet", "lang", "doc_id"),
}


def _laid_out_names(table: str) -> list[str]:
    _, last, _ = LAID_OUT[table]
    names = sorted(name for name in GIVEN_COLUMNS[table] if name != last)
    return [*names, *([last] if last else [])]


@query("\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{','.join(_laid_out_names(t))}' AS names, count(*) AS records, "
    f"CAST(sum({key}) AS BIGINT) AS keys, true AS same_files, true AS changed, false AS changed_again "
    f"FROM {t}"
    for t, (_, _, key) in LAID_OUT.items()
))
def layout_database(spark, sf_dir):
    # every table is laid out by its registered columns; none of its files is touched
    lake, dictionary = _database(spark, "lake"), _database(spark, "dictionary")
    for table, (fmt, last, _) in LAID_OUT.items():
        writer = read(spark, sf_dir, table).write.format(fmt)
        (writer.partitionBy(last) if last else writer).saveAsTable(f"{lake}.{table}")
    before = {t: sorted(load(spark, f"{lake}.{t}").inputFiles()) for t in LAID_OUT}
    batch.run_landing(spark, [lake], dictionary)
    changed = batch.run_layout(spark, lake, dictionary)
    again = batch.run_layout(spark, lake, dictionary)
    parts = []
    for table, (_, _, key) in LAID_OUT.items():
        rows = load(spark, f"{lake}.{table}")
        parts.append(
            rows.agg(
                F.lit(table).alias("table"),
                F.lit(",".join(rows.columns)).alias("names"),
                F.count(F.lit(1)).alias("records"),
                F.sum(key).cast("bigint").alias("keys"),
                F.lit(sorted(rows.inputFiles()) == before[table]).alias("same_files"),
                F.lit(table in changed).alias("changed"),
                F.lit(table in again).alias("changed_again"),
            )
        )
    return landing._union(parts)


@query("""
    SELECT 'events' AS "table", event_id AS key,
           CASE WHEN length(event_type) <> 5
                THEN 'lake.events.event_type.is_not_length_5' ELSE '' END AS tags
    FROM events
    UNION ALL
    SELECT 'orders', o_orderkey,
           CASE WHEN length(o_orderpriority) <> 8
                THEN 'lake.orders.o_orderpriority.is_not_length_8' ELSE '' END
    FROM orders
""")
def quality_from_dictionary(spark, sf_dir):
    # landed, laid out, set up, compiled, tagged and stored bucketed, then read back
    lake, dictionary = _database(spark, "lake"), _database(spark, "dictionary")
    for name in ("events", "orders"):
        read(spark, sf_dir, name).write.saveAsTable(f"{lake}.{name}")
    batch.run_pipeline(
        spark,
        [lake],
        keys={"events": "event_id", "orders": "o_orderkey"},
        null_tests=["event_id", "o_orderkey"],
        length_tests={"event_type": 5, "o_orderpriority": 8},
        dictionary=dictionary,
    )
    plain = F.replace(tags_text(), F.lit(f"{lake}."), F.lit("lake."))
    parts = [
        load(spark, f"{dictionary}.quality_{name}").select(
            F.lit(name).alias("table"), F.col(key).alias("key"), plain.alias("tags")
        )
        for name, key in (("events", "event_id"), ("orders", "o_orderkey"))
    ]
    return parts[0].unionByName(parts[1])


@query("""
    WITH source AS (
        SELECT o_orderkey AS key, o_orderstatus AS status, o_totalprice + 1 AS price FROM orders
        WHERE o_orderstatus = 'P'
        UNION ALL SELECT -o_orderkey - 1, 'N', o_totalprice FROM orders WHERE o_orderkey % 100 = 0)
    SELECT o_orderkey AS key, o_orderstatus AS status, o_totalprice AS price,
           true AS others_kept, 1 AS rewritten FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT key, status, price, true, 1 FROM source
""")
def merge_one_partition(spark, sf_dir):
    # a merge into one of the partitions: the files of the others stay where they are
    lake = _database(spark, "parts")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
    )
    orders.write.partitionBy("status").saveAsTable(f"{lake}.orders")
    updates = orders.where("status = 'P'").withColumn("price", F.col("price") + 1)
    new = orders.where("key % 100 = 0").select((-F.col("key") - 1).alias("key"), "price", F.lit("N").alias("status"))
    before = {f for f in load(spark, f"{lake}.orders").inputFiles() if "status=P" not in f}
    rewritten = batch.merge_table(
        spark, f"{lake}.orders", updates.unionByName(new), ["key"], {"price": "price"}, "*"
    )
    rows = load(spark, f"{lake}.orders")
    kept = before <= set(rows.inputFiles())
    return rows.select(
        "key", "status", "price", F.lit(kept).alias("others_kept"), F.lit(rewritten).alias("rewritten")
    )


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n,
           CASE WHEN count(*) > 1 THEN 'key_not_unique'
                WHEN length(any_value(l_returnflag)) <> 2 THEN 'lake.lines.l_returnflag.is_not_length_2'
                ELSE '' END AS tags,
           'a, [b]=c' AS delimiter, true AS quoted, CAST(2 AS BIGINT) AS skip_line,
           true AS at_own_place, 'l_orderkey; l_linenumber' AS key_text
    FROM lineitem GROUP BY l_orderkey, l_linenumber
""")
def quality_composite_key(spark, sf_dir):
    # a table at a location of its own, with properties and a key of two columns
    lake, dictionary = _database(spark, "lake"), _database(spark, "dictionary")
    path = scratch_path(spark, "own-place")
    names = ["l_returnflag", "l_linenumber", "l_orderkey"]
    lines = read(spark, sf_dir, "lineitem").select(*names)
    properties = {"delimiter": "a, [b]=c", "areColumnsQuoted": "true", "skip.header.line.count": "2"}
    ensure_table(spark, f"{lake}.lines", lines.schema, location=path, properties=properties)
    append_rows(lines, f"{lake}.lines")
    batch.run_pipeline(
        spark,
        [lake],
        keys={"lines": "l_orderkey; l_linenumber"},
        null_tests=["l_returnflag"],
        length_tests={"l_returnflag": 2},
        dictionary=dictionary,
    )
    facts = load(spark, f"{dictionary}.table").select(
        F.struct(
            "delimiter",
            F.col("are_columns_quoted").alias("quoted"),
            "skip_line",
            F.endswith("location", F.lit(path.rsplit("/", 1)[1])).alias("at_own_place"),
            F.col("Key").alias("key_text"),
        ).alias("facts")
    )
    plain = F.replace(tags_text(), F.lit(f"{lake}."), F.lit("lake.")).alias("tags")
    rows = load(spark, f"{dictionary}.quality_lines").select("l_orderkey", "l_linenumber", plain)
    counted = rows.groupBy("l_orderkey", "l_linenumber", "tags").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("facts", facts.scalar()).select(
        "l_orderkey", "l_linenumber", "n", "tags", "facts.*"
    )


@query("""
    SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day,
           count(DISTINCT strftime(ts, '%Y-%m-%d')) OVER () AS folders
    FROM events
""")
def land_files_twice(spark, sf_dir):
    # half of the days land first, the others in a second run; a third finds none
    lake = _database(spark, "landed")
    events = read(spark, sf_dir, "events").withColumn(
        "day", F.substring(F.col("ts").cast("string"), 1, 10)
    )
    early = F.pmod(F.xxhash64("day"), F.lit(2)) == 0
    path = scratch_path(spark, "events landing")
    for part in (events.where(early), events.where(~early), events.where("false")):
        part.withColumn("stamp", F.concat(F.lit("day "), "day")).write.mode("append").partitionBy(
            "stamp", "event_type"
        ).parquet(path)
        batch.land_files(spark, path, f"{lake}.events", f"{lake}.ledger")
    rows = load(spark, f"{lake}.events")
    days = rows.select(F.count_distinct("day").alias("n"))
    return rows.select("event_id", "event_type", "day", days.scalar().alias("folders"))


@query("""
    WITH fact AS (
        SELECT user_id, event_type, strftime(ts, '%d') <= '15' AS early, value FROM events),
    keys AS (
        SELECT user_id, event_type, count(*) AS n, count(*) FILTER (WHERE early) AS before,
               any_value(length(CAST(user_id AS VARCHAR))) AS width
        FROM fact GROUP BY ALL)
    SELECT user_id, event_type, CASE WHEN before > 0 THEN before ELSE n END AS n,
           CASE WHEN n > 1 THEN 'key_not_unique'
                WHEN width <> 2 THEN 'lake.events.user_id.is_not_length_2' ELSE '' END AS tags,
           (SELECT count(DISTINCT strftime(ts, '%Y-%m-%d')) FROM events) AS folders, 0 AS again
    FROM keys
""")
def quality_incremental(spark, sf_dir):
    # two landings, and a quality run after each, which reads the folders landed since
    lake, dictionary = _database(spark, "lake"), _database(spark, "dictionary")
    events = read(spark, sf_dir, "events").select(
        "user_id", "event_type", F.substring(F.col("ts").cast("string"), 1, 10).alias("day")
    )
    early = F.substring("day", 9, 2) <= "15"
    path = scratch_path(spark, "event days")
    counted = []
    for part in (events.where(early), events.where(~early)):
        part.write.mode("append").partitionBy("day").parquet(path)
        batch.land_files(spark, path, f"{lake}.events", f"{lake}.ledger")
        batch.run_landing(spark, [lake], dictionary)
        batch.configure_rules(
            spark, {"events": "user_id;event_type"}, [], {"user_id": 2}, dictionary, [lake]
        )
        counted.append(batch.run_quality_increment(spark, lake, "events", dictionary))
    again = batch.run_quality_increment(spark, lake, "events", dictionary)
    plain = F.replace(tags_text(), F.lit(f"{lake}."), F.lit("lake.")).alias("tags")
    rows = load(spark, f"{dictionary}.quality_events").select("user_id", "event_type", plain)
    return rows.groupBy("user_id", "event_type", "tags").agg(F.count(F.lit(1)).alias("n")).select(
        "user_id", "event_type", "n", "tags", F.lit(sum(counted)).cast("bigint").alias("folders"),
        F.lit(again).alias("again"),
    )


def _database(spark: SparkSession, label: str) -> str:
    """A database of its own for one run."""
    name = f"{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return name
