"""Column layout, test registry, and whole runs over a catalog."""

import pytest
from pyspark.sql import functions as F

from tablecheck.operators import layout, quality, registry, rules
from tablecheck.plans import batch
from tablecheck.sources import tables


@pytest.fixture
def columns(spark):
    rows = [
        ("lake.t", "lake", "t", "b", "bigint", "the b", 1, False),
        ("lake.t", "lake", "t", "sensor-type", "string", None, 2, False),
        ("lake.t", "lake", "t", "a", "int", "", 3, False),
        ("lake.t", "lake", "t", "gone", "int", None, 4, True),
        ("lake.v", "lake", "v", "b", "int", None, 1, False),
        ("other.t", "other", "t", "z", "int", None, 7, False),
        (None, "lake", "n", "z", "int", None, 8, False),
    ]
    return spark.createDataFrame(
        rows,
        "table_id string, database string, table string, column_name string, data_type string, "
        "description string, ordinal_position int, is_deleted boolean",
    )


@pytest.fixture
def known(spark):
    return spark.createDataFrame(
        [("lake", "t", False, False), ("lake", "v", True, False), ("lake", "gone", False, True)],
        "database string, table string, is_view boolean, is_deleted boolean",
    )


def test_reorder(columns):
    done = layout.reorder_alphabetically(columns, "LAKE")
    assert done.schema == columns.schema
    got = {(r.table_id, r.column_name): r.ordinal_position for r in done.collect()}
    assert got == {
        ("lake.t", "a"): 1,
        ("lake.t", "b"): 2,
        ("lake.t", "gone"): 3,
        ("lake.t", "sensor-type"): 4,
        ("lake.v", "b"): 1,
        ("other.t", "z"): 7,
        (None, "z"): 8,
    }


def test_reorder_refuses_a_column_listed_twice(columns):
    twice = columns.union(columns.where("table = 't' AND column_name = 'a'"))
    with pytest.raises(Exception, match="listed twice: lake.t.a"):
        layout.reorder_alphabetically(twice, "lake").collect()


def test_apply_layout(spark, columns, known):
    df = spark.createDataFrame(
        [(1, "s", 2, 3, 4)], "a bigint, `sensor-type` string, b int, gone int, extra int"
    ).withMetadata("a", {"comment": "old"})
    done = layout.apply_layout(df, columns, known, "Lake", "T")
    assert [(f.name, f.dataType.simpleString(), f.metadata.get("comment")) for f in done.schema] == [
        ("b", "bigint", "the b"),
        ("sensor-type", "string", None),
        ("a", "int", None),
    ]
    assert tuple(done.first()) == (2, "s", 1)
    assert layout.apply_layout(df, columns, known, "lake", "v") is df
    for table in ("nope", "gone"):
        with pytest.raises(KeyError):
            layout.apply_layout(df, columns, known, "lake", table)


def test_triage(spark):
    nulls = spark.createDataFrame(
        [("d", "t", "a", "d.t.a.is_null")] * 2,
        "database string, table string, column_name string, test_name string",
    )
    lengths = spark.createDataFrame(
        [("d", "t", "a", 3, "d.t.a.is_not_length_3")],
        "database string, table string, column_name string, length_test int, test_name string",
    )
    rows = {tuple(r) for r in registry.triage_rules(nulls, lengths).collect()}
    assert registry.triage_rules(nulls, lengths).count() == 3
    assert (None, None, None, "key_not_unique") in rows


@pytest.mark.parametrize("split", [False, True])
def test_sync_registry(spark, split):
    names = "database string, table string, column_name string, test_name string"
    known = spark.createDataFrame(
        [("d", "t", "a", "one", True, True), ("d", "t", "b", "two", True, False)],
        names + ", is_block boolean, is_deleted boolean",
    )
    triage = spark.createDataFrame([("d", "t", "a", "one"), (None, None, None, "key")], names)
    done = registry.sync_registry(known, triage, split_hot=split)
    assert {r.test_name: (r.is_block, r.is_deleted) for r in done.collect()} == {
        "one": (True, False),
        "two": (True, True),
        "key": (False, False),
    }
    again = registry.sync_registry(done, triage, split_hot=split)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(
        map(tuple, done.collect()), key=repr
    )


def test_runs_over_a_catalog(spark):
    for name in ("run_lake", "run_dictionary"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql("CREATE DATABASE run_lake")
    fact = spark.createDataFrame(
        [(1, "abc", None, "x"), (2, "ab", True, "x"), (3, "abc", True, "y"), (3, "abc", True, "y")],
        "event_id bigint, `sensor-type` string, visible boolean, day string",
    )
    fact.write.partitionBy("day").saveAsTable("run_lake.usa")
    spark.range(3).selectExpr("id AS z", "id AS a").write.saveAsTable("run_lake.plain")
    spark.sql("CREATE VIEW run_lake.look AS SELECT z FROM run_lake.plain")

    def run():
        batch.run_pipeline(
            spark,
            ["run_lake"],
            {"usa": "event_id"},
            null_tests=["visible", "event_id"],
            length_tests={"sensor-type": 3},
            dictionary="run_dictionary",
        )

    def tags():
        rows = tables.load(spark, "run_dictionary.quality_usa").collect()
        return sorted((r.event_id, r.data_quality_tag) for r in rows)

    run()
    bad = ["key_not_unique"]
    assert tags() == [
        (1, ["run_lake.usa.visible.is_null"]),
        (2, ["run_lake.usa.sensor-type.is_not_length_3"]),
        (3, bad),
        (3, bad),
    ]
    assert tables.table_layout(spark, "run_dictionary.quality_usa") == ([], (10, ["event_id"]))
    # columns are laid out by name, partition columns last
    assert tables.load(spark, "run_lake.usa").columns == [
        "event_id", "sensor-type", "visible", "day"
    ]
    assert tables.load(spark, "run_lake.plain").columns == ["a", "z"]
    assert tables.load(spark, "run_lake.look").columns == ["z"]
    names = tables.load(spark, "run_dictionary.is_block").where("NOT is_deleted")
    assert sorted(r.test_name for r in names.collect()) == [
        "key_not_unique",
        "run_lake.usa.event_id.is_null",
        "run_lake.usa.sensor-type.is_not_length_3",
        "run_lake.usa.visible.is_null",
    ]
    assert batch.apply_layout_all(spark, "run_lake", "run_dictionary") == []

    # a blocked test stays blocked, a new fact row is tested, a dropped table marked
    blocked = tables.load(spark, "run_dictionary.is_block").withColumn("is_block", F.lit(True))
    tables.replace_table(blocked, "run_dictionary.is_block")
    new = spark.createDataFrame([(9, "abc", True, "z")], fact.schema)
    tables.replace_table(tables.load(spark, "run_lake.usa").unionByName(new), "run_lake.usa")
    spark.sql("DROP VIEW run_lake.look")
    run()
    assert tags()[-1] == (9, [])
    assert len(tags()) == 5
    assert tables.load(spark, "run_dictionary.is_block").where("NOT is_block").count() == 0
    gone = tables.load(spark, "run_dictionary.table").where("is_deleted").collect()
    assert [r.table for r in gone] == ["look"]
    assert tables.load(spark, "run_dictionary.column").where("is_deleted").count() == 1


def test_land_files(spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS landing_lake CASCADE")
    spark.sql("CREATE DATABASE landing_lake")
    path = str(tmp_path / "in")
    name, ledger = "landing_lake.usa", "landing_lake.ledger"

    def put(day, ids, **more):
        df = spark.createDataFrame([(i,) for i in ids], "id bigint")
        df.withColumns({k: F.lit(v) for k, v in more.items()}).write.parquet(f"{path}/day={day}")

    def ids():
        return sorted((r.id, str(r.day)) for r in tables.load(spark, name).collect())

    put("2024-01-01", [1, 2])
    assert batch.land_files(spark, path, name, ledger) == 1
    assert batch.land_files(spark, path, name, ledger) == 0
    put("2024-01-02", [3], extra="x")
    put("2024-01-03", [4])
    assert batch.land_files(spark, path, name, ledger) == 2
    want = [(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-02"), (4, "2024-01-03")]
    assert ids() == want
    assert tables.load(spark, name).columns == ["id", "day", "folder"]
    # cut off before the ledger was written: landed again, no row twice
    tables.replace_table(
        tables.load(spark, ledger).where("folder NOT LIKE '%2024-01-03'"), ledger
    )
    assert batch.land_files(spark, path, name, ledger) == 1
    assert ids() == want
    assert tables.load(spark, ledger).count() == 3


def test_large_quality_table_gets_buckets_by_its_rows(spark, monkeypatch):
    for name in ("big_lake", "big_dictionary"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql("CREATE DATABASE big_lake")
    spark.range(100).toDF("id").write.saveAsTable("big_lake.t")
    batch.run_landing(spark, ["big_lake"], "big_dictionary")
    batch.configure_rules(spark, {"t": "id"}, dictionary="big_dictionary")
    batch.run_quality(spark, "big_lake", ["t"], "big_dictionary")
    name = "big_dictionary.quality_t"
    assert tables.table_layout(spark, name) == ([], (10, ["id"]))
    with monkeypatch.context() as rows:
        rows.setattr(batch, "ROWS_PER_BUCKET", 6)
        batch.run_quality(spark, "big_lake", ["t"], "big_dictionary")
    assert tables.table_layout(spark, name) == ([], (17, ["id"]))
    batch.run_quality(spark, "big_lake", ["t"], "big_dictionary")
    assert tables.table_layout(spark, name) == ([], (17, ["id"]))
    rows = tables.load(spark, name).collect()
    assert len(rows) == 100 and all(r.data_quality_tag == [] for r in rows)


def test_a_quality_run_reads_new_folders_only(spark, tmp_path):
    for name in ("inc_lake", "inc_dict"):
        spark.sql(f"CREATE DATABASE {name}")
    try:
        path = tmp_path / "in"
        key = "k bigint, v string"

        def run(day, rows_):
            spark.createDataFrame(rows_, key).coalesce(1).write.parquet(f"{path}/day={day}")
            batch.land_files(spark, str(path), "inc_lake.t", "inc_lake.ledger")
            if not full[1:]:
                batch.run_landing(spark, ["inc_lake"], "inc_dict")
                batch.configure_rules(spark, {"t": "k"}, ["v"], {}, "inc_dict")
            done = batch.run_quality_increment(spark, "inc_lake", "t", "inc_dict")
            # a full run over the same rows, from the same former state
            fact = tables.load(spark, "inc_lake.t")
            if not gone:
                full.append(quality.refresh_quality(fact, full[-1], rule, ["k"]).collect())
                full[-1] = spark.createDataFrame(full[-1], full[0].schema)
                assert tags("inc_dict.quality_t") == sorted(map(tag, full[-1].collect()), key=repr)
            return done

        def tag(row):
            return row.k, None if row.data_quality_tag is None else tuple(row.data_quality_tag)

        def tags(name):
            return sorted(map(tag, tables.load(spark, name).collect()), key=repr)

        gone = False
        rule = [rules.Rule("inc_lake.t.v.is_null", "v")]
        full = [spark.createDataFrame([], "k bigint, data_quality_tag array<string>")]
        assert run(1, [(1, "a"), (2, None), (3, "c"), (3, "d"), (None, "x")]) == 1
        assert run(2, [(1, "b"), (4, None), (None, "y"), (5, "e"), (5, None)]) == 1
        assert batch.run_quality_increment(spark, "inc_lake", "t", "inc_dict") == 0
        # the files of folders that were counted are not read again
        gone = True
        for file in spark.table("inc_lake.t").inputFiles():
            with open(file.removeprefix("file:").replace("///", "/").replace("%25", "%"), "w") as out:
                out.write("no parquet")
        assert run(3, [(2, "z"), (6, None), (7, "g")]) == 1
        found = dict(tags("inc_dict.quality_t"))
        assert found[2] == found[1] == ("key_not_unique",)
        assert found[6] == ("inc_lake.t.v.is_null",) and found[7] == () == found.get(8, ())
    finally:
        for name in ("inc_lake", "inc_dict"):
            spark.sql(f"DROP DATABASE {name} CASCADE")


def test_a_run_stores_each_dictionary_once(spark):
    for name in ("few_lake", "few_dict"):
        spark.sql(f"CREATE DATABASE {name}")
    try:
        for t in ("a", "b"):
            spark.range(9).selectExpr("id", "'x' AS v").write.saveAsTable(f"few_lake.{t}")
        spark.sparkContext.setJobGroup("few", "counted")
        batch.run_pipeline(spark, ["few_lake"], {"a": "id", "b": "id"}, ["v"], {"v": 1}, "few_dict")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("few")
        assert len(jobs) < 150  # every shuffle is a job of its own to adaptive execution
        assert spark.table("few_dict.quality_a").count() == 9
    finally:
        spark.sparkContext.setJobGroup("others", "not counted")
        for name in ("few_lake", "few_dict"):
            spark.sql(f"DROP DATABASE {name} CASCADE")


def test_buckets_grow_with_the_rows_and_stay_small():
    assert batch.bucket_number(1000, 100_000) == batch.BUCKETS
    assert batch.bucket_number(36_000_000, 100_000) == 36
    assert batch.bucket_number(216_000_000, 100_000) == 216
    assert batch.bucket_number(216_000_000, 100) == 100
