"""Tables, landing, folders and missing values."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions import mark_missing, normalize_missing, parse_properties, split_key
from tablecheck.functions.names import column_id, table_id
from tablecheck.plans import batch
from tablecheck.sources import dictionary as shapes
from tablecheck.sources import folders, footers, landing, schemas, tables
from tablecheck.sources.scratch import scratch_path


@pytest.fixture
def db(spark, request):
    name = "db_" + request.node.name.split("[")[0].lower()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


# ---------------------------------------------------------------- tables


def test_ensure_table(spark, db):
    schema = T.StructType.fromDDL("id bigint, `sensor-type` string, day string")
    name = f"{db}.t"
    assert tables.ensure_table(
        spark,
        name,
        schema,
        partition_by=["day"],
        bucket_by=(10, ["id"]),
        properties={"owner's": "a,b"},
    )
    assert not tables.ensure_table(spark, name, schema)
    assert tables.load(spark, name).columns == ["id", "sensor-type", "day"]
    assert tables.table_layout(spark, name) == (["day"], (10, ["id"]))
    assert tables.table_properties(spark, name)["owner's"] == "a,b"


def test_load_by_path(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.range(3).write.csv(path)
    assert tables.load(spark, path, "csv").count() == 3


def test_add_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    wide = tables.add_columns(df, {"x": "string", "B": "string", "y": "boolean"}, after="A")
    assert [(f.name, f.dataType.simpleString()) for f in wide.schema] == [
        ("a", "int"),
        ("x", "string"),
        ("y", "boolean"),
        ("b", "int"),
    ]
    assert wide.first()[1:3] == (None, None)
    assert tables.add_columns(df, {"z": "int"}).columns == ["a", "b", "z"]
    assert tables.add_columns(wide, {"x": "int"}).columns == wide.columns
    with pytest.raises(ValueError):
        tables.add_columns(df, {"z": "int"}, after="nope")


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_replace_table_reads_itself(spark, db, partition_by):
    name = f"{db}.column"  # a keyword
    tables.ensure_table(
        spark,
        name,
        T.StructType.fromDDL("id bigint, part string"),
        partition_by=partition_by,
        bucket_by=(4, ["id"]),
        properties={"k": "v"},
    )
    for run in range(3):
        new = spark.range(3).selectExpr("id", "concat('p', id) AS part")
        tables.replace_table(tables.load(spark, name).unionByName(new), name)
        assert tables.load(spark, name).count() == 3 * (run + 1)
        assert tables.load(spark, name).where("part = 'p1'").count() == run + 1
    assert tables.table_layout(spark, name) == (partition_by, (4, ["id"]))
    assert tables.table_properties(spark, name)["k"] == "v"
    assert [t.name for t in spark.catalog.listTables(db)] == ["column"]


def test_replace_keeps_external_location(spark, db, tmp_path):
    name, path = f"{db}.t", str(tmp_path / "outside")
    tables.ensure_table(spark, name, T.StructType.fromDDL("id bigint"), location=path)
    for _ in range(2):
        tables.replace_table(
            tables.load(spark, name).unionByName(spark.range(5).toDF("id")), name
        )
    assert tables.load(spark, name).count() == 10
    assert spark.read.parquet(path).count() == 10
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]


def test_recover_table(spark, db):
    name = f"{db}.t"
    spark.range(3).write.saveAsTable(name)
    # cut off between the two renames
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    spark.range(9).write.saveAsTable(f"{name}__stage")
    assert tables.recover_table(spark, name)
    assert tables.load(spark, name).count() == 3
    # cut off before the former content was dropped
    spark.range(1).write.saveAsTable(f"{name}__old")
    tables.replace_table(spark.range(4).toDF("id"), name)
    assert tables.load(spark, name).count() == 4
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]


def test_bucketed_quality_tables_join_without_exchange(spark, db):
    for table in ("a", "b"):
        tables.ensure_table(
            spark, f"{db}.{table}", T.StructType.fromDDL("id bigint"), bucket_by=(10, ["id"])
        )
        tables.replace_table(spark.range(100).toDF("id"), f"{db}.{table}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = tables.load(spark, f"{db}.a").join(tables.load(spark, f"{db}.b"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def bucket_files(spark, name):
    """How many files each bucket has."""
    files = [f.rsplit("_", 1)[1].split(".")[0] for f in spark.table(name).inputFiles()]
    return {b: files.count(b) for b in files}


def test_a_bucket_is_a_file_and_a_hot_one_several(spark, db):
    tables.ensure_table(spark, f"{db}.t", T.StructType.fromDDL("id bigint, v string"), bucket_by=(10, ["id"]))
    rows = spark.range(0, 64_000, 1, 32).selectExpr("id", "sha(string(id)) AS v")
    tables.replace_table(rows, f"{db}.t")
    assert len(bucket_files(spark, f"{db}.t")) == 10 and set(bucket_files(spark, f"{db}.t").values()) == {1}
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        tables.replace_table(rows.selectExpr("if(id % 2 = 0, 7L, id) AS id", "v"), f"{db}.t")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = bucket_files(spark, f"{db}.t")
    assert sorted(found.values())[-1] >= 4 and sorted(found.values())[-2] <= 2
    assert spark.table(f"{db}.t").where("id = 7").count() == 32_001
    assert spark.table(f"{db}.t").count() == 64_000


def test_a_merge_leaves_other_partitions_alone(spark, db):
    name = f"{db}.t"
    rows = spark.range(30).selectExpr("id", "'old' AS v", "nullif(id % 3, 0) AS p", "concat('q', id % 2) AS q")
    rows.write.partitionBy("p", "q").saveAsTable(name)
    before = set(spark.table(name).inputFiles())
    source = spark.createDataFrame([(3, "new", 9, "z"), (100, "add", 1, "q1"), (101, "add", None, "x")],
                                   "id long, v string, p long, q string")
    assert batch.merge_table(spark, name, source, ["id"], {"v": "v"}, "*") == 1
    gone = before - set(spark.table(name).inputFiles())
    assert gone and all("p=__HIVE_DEFAULT_PARTITION__/q=q1" in f for f in gone)
    got = {(r.id, r.v, r.p, r.q) for r in spark.table(name).collect()}
    want = {(r.id, r.v, r.p, r.q) for r in rows.where("id <> 3").collect()}
    assert got == want | {(3, "new", None, "q1"), (100, "add", 1, "q1"), (101, "add", None, "x")}
    assert batch.merge_table(spark, name, source, ["id"], {"v": "v"}, "*") == 3  # now all are known
    assert spark.table(name).count() == 32
    assert batch.merge_table(spark, name, source.where("false"), ["id"], {"v": "v"}, "*") == 0
    with pytest.raises(Exception, match="more than one source row"):
        batch.merge_table(spark, name, source.union(source), ["id"], {"v": "v"})
    # a partition column that is updated moves rows: the table is replaced
    assert batch.merge_table(spark, name, source, ["id"], {"q": "q"}) == -1
    assert {r.q for r in spark.table(name).where("id = 3").collect()} == {"z"}
    assert spark.table(name).count() == 32


# ---------------------------------------------------------------- landing


def test_land_columns(spark):
    df = spark.createDataFrame(
        [(1, None, [1.0]), (2, None, None)], "id bigint, `sensor-type` string, v array<double>"
    ).withMetadata("id", {"comment": "the \"key\" it's"})
    rows = landing.land_columns(df, "lake", "t", partition_by=["id"]).collect()
    assert [(r.columnName, r.dataType, r.ordinalPosition, r.null_count) for r in rows] == [
        ("id", "bigint", 1, 0),
        ("sensor-type", "string", 2, 2),
        ("v", "array<double>", 3, 1),
    ]
    assert rows[0].description == "the \"key\" it's" and rows[1].description is None
    assert rows[1].column_id == "lake.t.sensor-type" and rows[1].table_id == "lake.t"
    assert [r.isPartitioned for r in rows] == [True, False, False]
    plain = landing.land_columns(df, "lake", "t", measure=False)
    assert "null_count" not in plain.columns and plain.count() == 3


def test_land_tables_measures_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10000).repartition(3).write.parquet(path)
    sizes = [
        os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet")
    ]
    row = landing.land_tables(spark, {("lake", "t"): path}).first()
    assert (row.recordCount, row.objectCount, row.sizeKey) == (10000, 3, sum(sizes))
    assert row.avgRecordSize == sum(sizes) // 10000
    empty = str(tmp_path / "e")
    spark.range(0).write.parquet(empty)
    row = landing.land_tables(spark, {("lake", "e"): empty}).first()
    sizes = [os.path.getsize(os.path.join(empty, f)) for f in os.listdir(empty) if f.endswith(".parquet")]
    assert (row.recordCount, row.objectCount, row.sizeKey, row.avgRecordSize) == (0, 1, sum(sizes), 0)


def test_land_catalog(spark, db):
    tables.ensure_table(
        spark,
        f"{db}.t",
        T.StructType.fromDDL("id bigint, day string"),
        partition_by=["day"],
        properties={"delimiter": ",", "skip.header.line.count": "1", "areColumnsQuoted": "true"},
    )
    spark.sql(f"CREATE VIEW {db}.v AS SELECT 1 AS one")
    spark.range(1).createOrReplaceTempView("temporary_view")
    found = landing.list_tables(spark, [db])
    assert sorted(found) == [(db, "t"), (db, "v")]
    columns = landing.land_database_columns(spark, [db]).collect()
    assert {(r.table, r.columnName): r.isPartitioned for r in columns} == {
        ("t", "id"): False,
        ("t", "day"): True,
        ("v", "one"): False,
    }
    facts = landing.land_database_tables(spark, [db])
    rows = {r.table: r for r in facts.collect()}
    assert rows["t"].delimiter == "," and rows["t"].skipLine == 1
    assert rows["t"].classification == "parquet" and not rows["t"].is_view
    assert rows["v"].is_view and rows["v"].recordCount == 0
    creates = landing.land_create_statements(spark, [db])
    staged = {r.table: r for r in landing.stage_table_metadata(facts, creates).collect()}
    assert staged["t"].are_columns_quoted is True and staged["t"].skip_line == 1
    assert "CREATE TABLE" in staged["t"].create_statement
    assert "CREATE VIEW" in staged["v"].create_statement


def test_null_counts_of_footers_are_those_of_a_scan(spark, tmp_path):
    path = str(tmp_path / "wide x")
    rows = spark.range(500).selectExpr(
        "id", "if(id % 3 = 0, null, id) AS a", "if(id % 4 = 0, null, array(id, null)) AS list",
        "if(id % 5 = 0, null, named_struct('p', if(id % 2 = 0, null, id), 'q', id)) AS st",
        "if(id % 7 = 0, null, cast(id AS timestamp)) AS ts", "cast(id AS decimal(30, 2)) AS de",
        "if(id % 9 = 0, null, 'x') AS `a.b`", "if(id % 6 = 0, null, id % 2) AS part", "'y' AS later",
    )
    rows.drop("later").repartition(4).write.partitionBy("part").parquet(path)
    rows.write.mode("append").partitionBy("part").parquet(path)
    spark.range(0).write.mode("append").parquet(f"{path}/part=0")
    df = spark.read.option("mergeSchema", True).parquet(path)
    told = footers.null_counts(spark, path, df)
    want = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in df.columns]).first().asDict()
    assert set(told) == {"id", "a", "ts", "de", "a.b", "later"} and told["later"] == 500
    assert told == {c: want[c] for c in told}
    landed = landing.land_columns(df, "d", "t", known_nulls=told)
    assert {r.columnName: r.null_count for r in landed.collect()} == want
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<list:array<bigint>,st:struct" in plan


def test_flat_tables_are_measured_without_a_scan(spark, tmp_path):
    path = str(tmp_path / "flat")
    spark.range(10).selectExpr("id", "nullif(id, 3) AS b").write.parquet(path)
    landed = landing.land_file_columns(spark, path, "d", "t")
    assert {r.columnName: r.null_count for r in landed.collect()} == {"id": 0, "b": 1}
    assert "Scan parquet" not in landed._jdf.queryExecution().executedPlan().toString()


def test_chunks_without_statistics_are_scanned(spark, tmp_path):
    path = tmp_path / "bare"
    path.mkdir()
    pq.write_table(pa.table({"a": [1, None, 3], "b": [None, None, 1]}), path / "x.parquet", write_statistics=["a"])
    df = spark.read.parquet(str(path))
    assert footers.null_counts(spark, str(path), df) == {"a": 1}
    landed = landing.land_file_columns(spark, str(path), "d", "t")
    assert {r.columnName: r.null_count for r in landed.collect()} == {"a": 1, "b": 2}
    assert "ReadSchema: struct<b:bigint>" in landed._jdf.queryExecution().executedPlan().toString()


def test_stores_out_of_reach_are_scanned(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(footers.folders, "_reaches", lambda encoded: False)
    spark.range(4).write.parquet(str(tmp_path / "x"))
    landed = landing.land_file_columns(spark, str(tmp_path / "x"), "d", "t")
    assert [r.null_count for r in landed.collect()] == [0]


def test_empty_files_are_counted(spark, db):
    name = f"{db}.t"
    spark.range(5).coalesce(1).write.saveAsTable(tables.quoted(name))
    spark.range(0).coalesce(1).write.mode("append").saveAsTable(tables.quoted(name))
    facts = landing.land_database_tables(spark, [db])
    row = facts.first()
    assert (row.recordCount, row.objectCount) == (5, 2) and row.sizeKey > 0
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and "file_path" not in plan


def test_tables_that_are_not_files_land_with_zero(spark, db, monkeypatch):
    spark.range(3).write.saveAsTable(f"{db}.t")
    known = landing.table_description
    monkeypatch.setattr(landing, "table_description", lambda s, n: known(s, n) | {"provider": "jdbc"})
    row = landing.land_database_tables(spark, [db]).first()
    assert (row.recordCount, row.objectCount, row.sizeKey, row.classification) == (0, 0, 0, "jdbc")


def test_properties_are_exact(spark, db):
    odd = {"a": "x, [y]=z", "delimiter": ",", "b,c": "]", "q": "it's \\ "}
    tables.ensure_table(spark, f"{db}.t", T.StructType.fromDDL("id bigint"), properties=odd)
    assert tables.table_properties(spark, f"{db}.t") == odd
    assert landing.land_database_tables(spark, [db]).first().delimiter == ","


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_columns_are_laid_out_without_touching_files(spark, db, fmt, tmp_path):
    name = f"{db}.t"
    rows = spark.range(6).selectExpr("id AS b", "'x' AS a", "id * 2 AS c", "id % 2 AS p")
    rows.write.format(fmt).partitionBy("p").option("path", str(tmp_path / "own")).saveAsTable(name)
    tables._set_properties(spark, name, {"k": "v"})
    before = sorted(spark.table(name).inputFiles())
    order = T.StructType.fromDDL("a string COMMENT 'it''s', b bigint, c bigint, p bigint")
    tables.lay_out_columns(spark, name, order)
    now = spark.table(name)
    assert now.columns == ["a", "b", "c", "p"] and now.schema["a"].metadata["comment"] == "it's"
    assert sorted(now.inputFiles()) == before and tables.table_properties(spark, name)["k"] == "v"
    assert sorted(map(tuple, now.collect())) == [("x", i, 2 * i, i % 2) for i in range(6)]
    tables.lay_out_columns(spark, name, T.StructType.fromDDL("c bigint, b bigint, p bigint"))
    assert spark.table(name).columns == ["c", "b", "p"]
    spark.range(1).selectExpr("5L AS c", "7L AS b", "1L AS p").write.insertInto(name)
    assert (7, 5) in {(r.b, r.c) for r in spark.table(name).collect()}
    for lost in ("c bigint, b bigint", "c string, b bigint, p bigint", "d bigint, p bigint"):
        with pytest.raises(ValueError, match="rewrite"):
            tables.lay_out_columns(spark, name, T.StructType.fromDDL(lost))


@pytest.mark.parametrize("fmt", ["csv", "text"])
def test_formats_by_position_cannot_be_laid_out(spark, db, fmt):
    spark.range(2).selectExpr("'x' AS a").write.format(fmt).saveAsTable(f"{db}.t")
    with pytest.raises(ValueError, match="position"):
        tables.lay_out_columns(spark, f"{db}.t", spark.table(f"{db}.t").schema)


def facts_row(spark, **given):
    names = (
        "database table updateCrawler areColumnsQuoted avgRecordSize classification "
        "columnsOrdered compressionType delimiter objectCount recordCount sizeKey skipLine "
        "typeData location description"
    ).split()
    row = {n: given.get(n) for n in names}
    row.update(database=given.get("database", "d"), table=given.get("table", "t"))
    df = spark.createDataFrame([tuple(row[n] for n in names)], ", ".join(f"`{n}` string" for n in names))
    return df.withColumn("is_view", F.lit(False))


@pytest.mark.parametrize(
    "text,flag,label",
    [
        ("None", False, None),
        ("none", False, None),
        (None, False, None),
        ("true", True, "true"),
        ("maybe", None, "maybe"),
    ],
)
def test_staged_flags(spark, text, flag, label):
    facts = facts_row(
        spark, areColumnsQuoted=text, columnsOrdered=text, classification=text, recordCount=text
    )
    creates = spark.createDataFrame(
        [("d", "t", "CREATE")], "database string, table string, createStatement string"
    )
    row = landing.stage_table_metadata(facts, creates).first()
    assert row.are_columns_quoted is flag and row.columns_ordered is flag
    assert row.classification == label
    assert row.record_count is None
    assert row.table_id == "d.t" and row.is_deleted is False


@pytest.mark.parametrize(
    "text,number", [("", None), ("12", 12), ("3000000000", 3000000000), ("x", None), (None, None)]
)
def test_staged_numbers(spark, text, number):
    creates = spark.createDataFrame(
        [("d", "t", "C")], "database string, table string, createStatement string"
    )
    row = landing.stage_table_metadata(facts_row(spark, sizeKey=text, description="none"), creates).first()
    assert row.size_key == number and row.description == "none"


def test_sync_columns_and_tables(spark):
    old = spark.createDataFrame([(1, "x")], "a int, b string")
    empty = tables.local_rows(spark, [], shapes.COLUMN_DICTIONARY)
    first = landing.sync_columns(empty, landing.land_columns(old, "d", "t", measure=False))
    elsewhere = landing.sync_columns(first, landing.land_columns(old, "d2", "u", measure=False))
    assert not elsewhere.where("is_deleted").count()
    new = spark.createDataFrame([("1", 2)], "c string, a int")
    second = landing.sync_columns(elsewhere, landing.land_columns(new, "d", "t", measure=False))
    got = {
        (r.table_id, r.column_name): (r.ordinal_position, r.is_deleted) for r in second.collect()
    }
    assert got == {
        ("d.t", "a"): (2, False),
        ("d.t", "b"): (2, True),
        ("d.t", "c"): (1, False),
        ("d2.u", "a"): (1, False),
        ("d2.u", "b"): (2, False),
    }
    # a column that comes back is no longer deleted
    third = landing.sync_columns(second, landing.land_columns(old, "d", "t", measure=False))
    assert {r.column_name: r.is_deleted for r in third.where("table = 't'").collect()} == {
        "a": False,
        "b": False,
        "c": True,
    }
    creates = spark.createDataFrame(
        [("d", "t", "C1")], "database string, table string, createStatement string"
    )
    staged = landing.stage_table_metadata(facts_row(spark, description="one", skipLine="1"), creates)
    known = tables.add_columns(
        tables.local_rows(spark, [], shapes.TABLE_DICTIONARY), shapes.TABLE_KEY, "description"
    )
    known = landing.sync_tables(known, staged)
    assert known.columns[4] == "Key" and known.first().Key is None
    again = landing.stage_table_metadata(
        facts_row(spark, description="two", skipLine="2", location="/new"), creates
    )
    row = landing.sync_tables(known, again).first()
    assert (row.description, row.skip_line, row.location) == ("one", 1, "/new")
    row = landing.sync_tables(known, again, refresh=["description"]).first()
    assert (row.description, row.skip_line) == ("two", 1)
    other = landing.stage_table_metadata(
        facts_row(spark, database="d9"),
        creates.withColumn("database", F.lit("d9")),
    )
    scoped = {r.database: r.is_deleted for r in landing.sync_tables(known, other).collect()}
    assert scoped == {"d": False, "d9": False}
    unscoped = landing.sync_tables(known, other, scoped=False).collect()
    assert {r.database: r.is_deleted for r in unscoped} == {"d": True, "d9": False}


# ---------------------------------------------------------------- functions


def test_parse_properties(spark):
    texts = ["a=1,delimiter=,,b=x=y", "[a=1]", "[a=1, delimiter=,, b=2]", "", None, "a=,b=2"]
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    got = [r[0] for r in df.select(parse_properties("p")).collect()]
    assert got == [
        {"a": "1", "delimiter": ",", "b": "x=y"},
        {"a": "1"},
        {"a": "1", "delimiter": ",", "b": "2"},
        None,
        None,
        {"a": "", "b": "2"},
    ]


def test_missing_markers(spark):
    df = spark.createDataFrame([("None", "none", None), ("x", "None", 5)], "a string, b string, n int")
    one = normalize_missing(df)
    assert [tuple(r) for r in one.collect()] == [(None, "none", None), ("x", None, 5)]
    per_column = normalize_missing(df, {"b": ["None", "none"]}, {"n": 0})
    assert [tuple(r) for r in per_column.collect()] == [("None", None, 0), ("x", None, 5)]
    marked = mark_missing(one, defaults={"n": 0})
    assert [tuple(r) for r in marked.collect()] == [("None", "none", 0), ("x", "None", 5)]


def test_ids(spark):
    df = spark.createDataFrame([("d", "t", "c"), ("d", None, "c")], "database string, table string, column_name string")
    got = [tuple(r) for r in df.select(table_id(), column_id()).collect()]
    assert got == [("d.t", "d.t.c"), (None, "d.c")]
    assert split_key("a; b ;c") == ["a", "b", "c"]


# ---------------------------------------------------------------- folders


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_land_new_folders(spark, tmp_path, fmt):
    path = str(tmp_path / "in")
    schema = T.StructType.fromDDL("id bigint, name string")

    def put(day, ids, extra=False):
        df = spark.createDataFrame([(i, f"n{i}") for i in ids], schema)
        if extra:
            df = df.withColumn("extra", F.lit(1))
        writer = df.coalesce(1).write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(f"{path}/day={day}")

    options = {"header": "true"} if fmt == "csv" else {}
    put("2024-01-01", [1, 2])
    put("2024-01-02", [3])
    first = folders.land_new_folders(spark, path, None, fmt, schema, **options)
    assert sorted(r.id for r in first.collect()) == [1, 2, 3]
    ledger = folders.new_folders(spark, path, None)
    assert ledger.count() == 2
    ledger.write.parquet(str(tmp_path / "ledger"))
    ledger = spark.read.parquet(str(tmp_path / "ledger"))

    none = folders.land_new_folders(spark, path, ledger, fmt, schema, **options)
    assert none.count() == 0 and none.columns == ["id", "name", "folder"]
    put("2024-01-03", [4, 5], extra=fmt != "csv")
    later = folders.land_new_folders(spark, path, ledger, fmt, schema, **options)
    assert sorted((r.id, r.name, str(r.day)) for r in later.collect()) == [
        (4, "n4", "2024-01-03"),
        (5, "n5", "2024-01-03"),
    ]
    assert "extra" not in later.columns
    assert {r.folder.rsplit("/", 1)[1] for r in later.collect()} == {"day=2024-01-03"}
    inferred = folders.land_new_folders(spark, path, ledger, fmt, **options)
    assert dict(inferred.dtypes)["id"] in ("bigint", "int")
    # only the new folder is read
    assert all("day=2024-01-03" in f for f in later.inputFiles())


def touch(path, *names):
    for name in names:
        (path / name).parent.mkdir(parents=True, exist_ok=True)
        (path / name).write_text("1")


def test_landed_folders_are_not_listed_again(spark, tmp_path):
    for n in range(10_000):
        (tmp_path / f"in/{n // 100}/{n}").mkdir(parents=True)
    touch(tmp_path / "in", *[f"{n // 100}/{n}/a.txt" for n in range(10_000)])
    path = str(tmp_path / "in")
    first = folders.new_folders(spark, path, None)
    assert first.count() == 10_000
    first.write.parquet(str(tmp_path / "ledger"))
    ledger = spark.read.parquet(str(tmp_path / "ledger"))
    touch(tmp_path / "in", "7/new/b.txt", "7/new/c.txt")
    seen = folders.listed(spark, path, ledger)
    assert sorted(r.path.rsplit("/", 1)[1] for r in seen.where("not is_folder").collect()) == ["b.txt", "c.txt"]
    assert [r.folder.rsplit("/", 2)[1:] for r in folders.new_folders(spark, path, ledger).collect()] == [["7", "new"]]


@pytest.mark.parametrize("reached", [True, False])
def test_listing_goes_below_landed_folders_that_hold_folders(spark, tmp_path, monkeypatch, reached):
    if not reached:
        monkeypatch.setattr(folders, "_reaches", lambda encoded: False)
    top = tmp_path / "a b%20+ü"
    touch(top, "root.txt", "x/f.txt", "x/y/g.txt", "z/_hidden", "z/.crc", "_tmp/h.txt", "_p=1/i.txt", "q/r/s/j.txt")
    path = str(top)

    def names(df):
        return sorted(r.folder[len(f"file:{path}") :] for r in df.collect())

    found = folders.new_folders(spark, path, None)
    assert names(found) == ["", "/_p=1", "/q/r/s", "/x", "/x/y"]
    spark_lists = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    assert {r.path for r in spark_lists.select("path").collect()} == {
        r.path for r in folders.listed(spark, path).where("not is_folder").collect()
    }
    ledger = spark.createDataFrame(found.collect(), shapes.LEDGER)
    assert names(folders.new_folders(spark, path, ledger)) == []
    touch(top, "x/new/k.txt", "new/l.txt", "x/y/m.txt", "q/n.txt")
    assert names(folders.new_folders(spark, path, ledger)) == ["/new", "/q", "/x/new"]
    sizes = {r.path.rsplit("/", 1)[1]: r.length for r in folders.listed(spark, path).where("not is_folder").collect()}
    assert sizes["g.txt"] == 1 and "h.txt" not in sizes


def test_a_missing_path_cannot_be_listed(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)not exist|no such|FileNotFound"):
        folders.new_folders(spark, str(tmp_path / "nowhere"), None).count()


def test_folders_land_in_rounds(spark, shelf, tmp_path):
    for n in range(9):
        spark.range(n).write.parquet(str(tmp_path / f"lake/day={n}"))
    path = str(tmp_path / "lake")
    assert batch.land_files(spark, path, "shelf.l", "shelf.ledger", folders_at_once=2) == 9
    assert spark.table("shelf.l").count() == 36 and spark.table("shelf.ledger").count() == 9
    assert batch.land_files(spark, path, "shelf.l", "shelf.ledger", folders_at_once=2) == 0


def test_first_landing_takes_the_schema_all_files_fit(spark, shelf, tmp_path):
    lake = tmp_path / "lake"
    spark.range(3).selectExpr("int(id) AS a", "1L AS b", "date'2024-01-02' AS t").write.parquet(str(lake / "day=1"))
    spark.range(3).selectExpr("id + 0.5D AS a", "2 AS b", "'x' AS later", "timestamp'2024-01-02 03:04:05' AS t",
                              ).write.parquet(str(lake / "day=2"))
    spark.range(1).selectExpr("9L AS a", "cast(1.25 AS decimal(5,2)) AS b").write.parquet(str(lake / "day=3"))
    assert batch.land_files(spark, str(lake), "shelf.l", "shelf.ledger") == 3
    rows = spark.table("shelf.l")
    kinds = dict(rows.dtypes)
    assert (kinds["a"], kinds["t"], kinds["later"], kinds["day"]) == ("double", "timestamp", "string", "int")
    assert kinds["b"] == "decimal(21,2)"
    got = sorted((r.a, float(r.b), r.later, r.day) for r in rows.collect())
    assert got == [(0.0, 1.0, None, 1), (0.5, 2.0, "x", 2), (1.0, 1.0, None, 1), (1.5, 2.0, "x", 2),
                   (2.0, 1.0, None, 1), (2.5, 2.0, "x", 2), (9.0, 1.25, None, 3)]
    # later files never alter the table; what does not fit is NULL
    spark.sql("SELECT 'odd' AS a, '7' AS b, 5 AS later, 1 AS more").write.parquet(str(lake / "day=4"))
    assert batch.land_files(spark, str(lake), "shelf.l", "shelf.ledger") == 1
    row = spark.table("shelf.l").where("day = 4").first()
    assert (row.a, float(row.b), row.later) == (None, 7.0, "5") and "more" not in spark.table("shelf.l").columns


@pytest.mark.parametrize(
    "a,b,both",
    [
        ("tinyint", "int", "int"), ("bigint", "double", "double"), ("float", "int", "double"),
        ("bigint", "decimal(5,2)", "decimal(21,2)"), ("decimal(38,0)", "decimal(38,2)", "string"),
        ("date", "timestamp", "timestamp"), ("int", "string", "string"), ("boolean", "int", "string"),
        ("array<int>", "array<double>", "array<double>"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
        ("struct<x:int,y:int>", "struct<Y:bigint,z:date>", "struct<x:int,y:bigint,z:date>"),
        ("array<int>", "int", "string"), ("void", "date", "date"),
    ],
)
def test_common_types(spark, a, b, both):
    kinds = [T.StructType.fromDDL(f"c {kind}")["c"].dataType for kind in (a, b)]
    assert schemas.common_type(*kinds).simpleString() == both
    if "struct" not in a:
        assert schemas.common_type(*kinds[::-1]).simpleString() == both


def test_scratch_path_follows_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    if before:
        assert path.startswith(before)


def test_repeated_property_keeps_its_last_value(spark):
    row = spark.range(1).select(parse_properties(F.lit("[note=p, q, q, a=1, a=2]")).alias("m")).first()
    assert row["m"] == {"note": "p", "q": None, "a": "2"}


@pytest.fixture
def shelf(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf")
    yield "shelf"
    spark.sql("DROP DATABASE shelf CASCADE")


@pytest.mark.parametrize("fmt", ["json", "orc", "csv", "parquet"])
def test_replacing_keeps_provider_and_comment(spark, shelf, fmt):
    spark.range(3).selectExpr("id AS b", "'x' AS a").write.format(fmt).saveAsTable("shelf.t")
    spark.sql("COMMENT ON TABLE shelf.t IS 'it''s kept'")
    tables.replace_table(spark.table("shelf.t").select("a", "b"), "shelf.t")
    detail = tables.table_detail(spark, "shelf.t")
    assert detail["Provider"].lower() == fmt and detail["Comment"] == "it's kept"
    assert spark.table("shelf.t").columns == ["a", "b"] and spark.table("shelf.t").count() == 3


def test_foreign_files_are_left_alone(spark, shelf, tmp_path):
    path = str(tmp_path / "landed")
    spark.range(3).selectExpr("id AS b", "'x' AS a").write.option("header", True).csv(path)
    spark.sql(f"CREATE TABLE shelf.c (b BIGINT, a STRING) USING csv OPTIONS (header true) LOCATION '{path}'")
    before = sorted(os.listdir(path))
    with pytest.raises(ValueError, match="another format"):
        tables.replace_table(spark.table("shelf.c").select("a", "b"), "shelf.c")
    assert sorted(os.listdir(path)) == before and spark.table("shelf.c").count() == 3


def test_a_cut_rewrite_at_a_location_is_finished_there(spark, shelf, tmp_path):
    path = str(tmp_path / "own")
    spark.range(3).write.option("path", path).saveAsTable("shelf.e")
    spark.range(5).write.saveAsTable("shelf.e__stage")
    tables._set_properties(spark, "shelf.e__stage", {tables._LOCATION: f"file:{path}"})
    spark.sql("DROP TABLE shelf.e")
    assert tables.recover_table(spark, "shelf.e")
    assert spark.table("shelf.e").count() == 5
    detail = tables.table_detail(spark, "shelf.e")
    assert detail["Type"] == "EXTERNAL" and detail["Location"].endswith("/own")
    assert tables._LOCATION not in tables.table_properties(spark, "shelf.e")


@pytest.mark.parametrize("day", ["a b", "a%b", "10:30", "ümlaut", "a+b"])
def test_odd_folder_names_land_once(spark, shelf, tmp_path, day):
    spark.range(5).write.parquet(str(tmp_path / f"lake/run {day}"))
    assert batch.land_files(spark, str(tmp_path / "lake"), "shelf.l", "shelf.ledger") == 1
    # the rows were stored, the ledger was not
    spark.sql("TRUNCATE TABLE shelf.ledger")
    assert batch.land_files(spark, str(tmp_path / "lake"), "shelf.l", "shelf.ledger") == 1
    assert spark.table("shelf.l").count() == 5
    assert batch.land_files(spark, str(tmp_path / "lake"), "shelf.l", "shelf.ledger") == 0
