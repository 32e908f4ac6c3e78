"""Row tests on edge rows: NULLs, repeated keys, odd names, missing rules."""

import pytest
from pyspark.sql import functions as F

from tablecheck.operators import quality, rules
from tablecheck.operators.rules import Rule
from tablecheck.sources.tables import ensure_table, load, replace_table

RULES = [Rule("db.t.c.is_null", "c"), Rule("db.t.d.is_not_length_3", "d", 3)]


def tags(df, keys=("id",)):
    return {tuple(r[k] for k in keys): r[quality.TAG] for r in df.collect()}


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [
            (1, None, "abc"),
            (2, "x", "abcd"),
            (3, "x", None),
            (4, None, "ab"),
            (5, "x", "abc"),
            (7, None, "abc"),
            (7, "x", "abcd"),
            (None, "x", "abc"),
        ],
        "id bigint, c string, d string",
    )


EXPECTED = {
    (1,): ["db.t.c.is_null"],
    (2,): ["db.t.d.is_not_length_3"],
    (3,): [],
    (4,): ["db.t.c.is_null", "db.t.d.is_not_length_3"],
    (5,): [],
    (7,): ["key_not_unique"],
    (None,): ["key_not_unique"],
}


def test_tag_keys(fact):
    assert tags(quality.tag_keys(fact, RULES, ["id"])) == EXPECTED


@pytest.mark.parametrize("parts", [1, 8])
def test_tag_keys_any_partitioning(spark, fact, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert tags(quality.tag_keys(fact.repartition(parts), RULES, ["id"])) == EXPECTED
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_row_per_key(fact):
    tagged = quality.tag_keys(fact, RULES, ["id"])
    assert tagged.count() == fact.select("id").distinct().count()


@pytest.mark.parametrize("split", [False, True])
def test_with_tags(fact, split):
    rows = quality.with_tags(fact, RULES, ["id"], split_hot=split).collect()
    assert len(rows) == 8
    for row in rows:
        assert row[quality.TAG] == EXPECTED[(row["id"],)]


def test_with_tags_large_table_is_not_shuffled(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    fact.write.parquet(path)
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1b")
    try:
        tagged = quality.with_tags(spark.read.parquet(path), RULES, ["id"])
        plan = tagged._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert [r[quality.TAG] == EXPECTED[(r["id"],)] for r in tagged.collect()] == [True] * 8
    finally:
        spark.conf.set(name, before)


def test_tag_rows_ignores_keys(fact):
    rows = quality.tag_rows(fact, RULES, ["id"]).where("id = 7").collect()
    assert sorted(r[quality.TAG] for r in rows) == [["db.t.c.is_null"], ["db.t.d.is_not_length_3"]]


def test_no_rules(fact):
    found = tags(quality.tag_keys(fact, [], ["id"]))
    assert found[(1,)] == [] and found[(7,)] == ["key_not_unique"]
    assert {tuple(r[quality.TAG]) for r in quality.tag_rows(fact, [], ["id"]).collect()} == {()}


def test_composite_key_with_null_part(spark):
    df = spark.createDataFrame(
        [(1, 1, "x"), (1, 2, "x"), (1, None, "x"), (2, 1, "x"), (2, 1, "x")],
        "a int, b int, c string",
    )
    found = tags(quality.tag_keys(df, RULES[:1], ["a", "b"]), ("a", "b"))
    bad = ["key_not_unique"]
    assert found == {(1, 1): [], (1, 2): [], (1, None): bad, (2, 1): bad}
    counts = {(r["a"], r["b"]): r["key_count"] for r in quality.key_counts(df, ["a", "b"]).collect()}
    assert counts == {(1, 1): 1, (1, 2): 1, (1, None): 0, (2, 1): 2}


@pytest.mark.parametrize("n", [2, 16, 17, 63, 64, 200])
def test_many_rules(spark, n):
    df = spark.createDataFrame([(1, "abc"), (2, "a"), (3, None)], "id int, s string")
    found = [Rule(f"r{i}", "s", i) for i in range(n)]
    want = {
        (1,): [f"r{i}" for i in range(n) if i != 3],
        (2,): [f"r{i}" for i in range(n) if i != 1],
        (3,): [],
    }
    assert tags(quality.tag_keys(df, found, ["id"])) == want
    assert tags(quality.tag_rows(df, found, ["id"])) == want


def test_odd_names_and_numbers(spark):
    df = spark.createDataFrame(
        [(1, "ab", 1234), (2, "abc", 123)], "`row-id` int, `sensor-type` string, `a.b` int"
    )
    found = [Rule("n", "sensor-type"), Rule("l", "sensor-type", 3), Rule("m", "a.b", 3)]
    assert tags(quality.tag_keys(df, found, ["row-id"]), ("row-id",)) == {
        (1,): ["l", "m"],
        (2,): [],
    }
    assert tags(quality.with_tags(df, found, ["row-id"]), ("row-id",)) == {
        (1,): ["l", "m"],
        (2,): [],
    }


def test_scan_reads_used_columns_only(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(10).selectExpr("id", "id AS a", "id AS b", "id AS c").write.parquet(path)
    tagged = quality.tag_keys(spark.read.parquet(path), [Rule("r", "b")], ["id"])
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,b:bigint>" in plan
    assert "Cartesian" not in plan and "SortAggregate" not in plan


# ---------------------------------------------------------------- quality tables


def quality_rows(df):
    return sorted(
        ((r["id"], r[quality.TAG]) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0)
    )


@pytest.mark.parametrize("split", [False, True])
def test_seed_twice(spark, fact, split):
    empty = spark.createDataFrame([], quality.quality_schema(fact, ["id"]))
    once = quality.seed_quality(fact, empty, ["id"], split_hot=split)
    assert quality_rows(once) == [(i, None) for i in (1, 2, 3, 4, 5, 7, 7, None)]
    twice = quality.seed_quality(fact, once, ["id"], split_hot=split)
    assert quality_rows(twice) == quality_rows(once)


@pytest.mark.parametrize("split", [False, True])
def test_refresh_and_later_runs(spark, fact, split):
    empty = spark.createDataFrame([], quality.quality_schema(fact, ["id"]))
    first = quality.refresh_quality(fact, empty, RULES, ["id"])
    want = [(i, EXPECTED[(i,)]) for i in (1, 2, 3, 4, 5, 7, 7, None)]
    assert quality_rows(first) == want
    # new fact rows are seeded and tagged, removed ones keep their tags
    later = fact.where("id <> 1").union(
        spark.createDataFrame([(9, None, "abc")], "id bigint, c string, d string")
    )
    second = quality.refresh_quality(later, first, RULES, ["id"])
    want = want[:-1] + [(9, ["db.t.c.is_null"]), (None, ["key_not_unique"])]
    assert quality_rows(second) == want


@pytest.mark.parametrize("runs", [1, 2])
def test_refresh_reads_the_fact_once_and_spreads_a_hot_key(spark, tmp_path, runs):
    path = str(tmp_path / "fact")
    hot = "CASE WHEN id % 3 = 0 THEN -1L ELSE id END AS id"
    spark.range(60_000).selectExpr(hot, "'a' AS code", "NULL AS visible").write.parquet(path)
    fact = spark.read.parquet(path)
    spark.sql("CREATE DATABASE IF NOT EXISTS refresh_plans")
    name = "refresh_plans.quality_t"
    ensure_table(spark, name, quality.quality_schema(fact, ["id"]), bucket_by=(8, ["id"]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    rules = [Rule("d.t.code.is_not_length_3", "code", 3)]
    try:
        for _ in range(runs):
            done = quality.refresh_quality(fact, load(spark, name), rules, ["id"])
            done.collect()
            plan = done._jdf.queryExecution().executedPlan().toString()
            final = plan.split("== Initial Plan ==")[0]
            assert final.count(f"{path}]") <= final.count("ReusedExchange") + 1
            assert final.count("Bucketed: true") <= 1  # its distinct keys, not its rows
            replace_table(done, name, bucket_by=(8, ["id"]))
        got = load(spark, name).groupBy("id").count().where("count > 1").collect()
        assert [(r["id"], r["count"]) for r in got] == [(-1, 20_000)]
        assert load(spark, name).count() == 60_000
        failed = F.array_contains("data_quality_tag", "d.t.code.is_not_length_3")
        assert load(spark, name).where(failed).count() == 40_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE refresh_plans CASCADE")


def test_rows_of_a_frequent_new_key_are_added_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(quality, "_REPEATED_AT_ONCE", 7)
    fact = spark.createDataFrame([(1,)] * 50 + [(2,)], "id int")
    empty = spark.createDataFrame([], quality.quality_schema(fact, ["id"]))
    done = quality.refresh_quality(fact, empty, [], ["id"])
    assert {r["id"]: r["count"] for r in done.groupBy("id").count().collect()} == {1: 50, 2: 1}


def test_length_of_binary_counts_bytes(spark):
    df = spark.createDataFrame([(1, bytearray("é".encode()))], "id int, b binary")
    rules = [Rule("d.t.b.is_not_length_2", "b", 2)]
    assert quality.tag_rows(df, rules, ["id"]).first()["data_quality_tag"] == []


@pytest.mark.parametrize("count", [2, 20])
def test_a_rule_may_be_called_pass(spark, count):
    df = spark.createDataFrame([(1, None)], "id int, v string")
    rules = [Rule("PASS" if i == 0 else f"r{i}", "v") for i in range(count)]
    tags = quality.tag_rows(df, rules, ["id"]).first()["data_quality_tag"]
    assert tags == [rule.name for rule in rules]



@pytest.mark.parametrize("split", [False, True])
def test_refresh_composite_key_with_null_parts(spark, split):
    df = spark.createDataFrame(
        [(1, None, "x"), (1, None, None), (None, 2, "x"), (3, 4, "x"), (3, 5, None)],
        "a int, b bigint, c string",
    )
    known = spark.createDataFrame(
        [(1, None, None), (9, 9, ["old"])], "a int, b bigint, data_quality_tag array<string>"
    )
    once = quality.refresh_quality(df, known, RULES[:1], ["a", "b"])
    bad = ["key_not_unique"]
    want = [
        (1, None, bad),
        (None, 2, bad),
        (3, 4, []),
        (3, 5, ["db.t.c.is_null"]),
        (9, 9, ["old"]),
    ]
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(want, key=repr)
    again = quality.refresh_quality(df, once, RULES[:1], ["a", "b"])
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(want, key=repr)


def test_apply_tags_needs_unique_tags(spark):
    known = spark.createDataFrame([(1, None)], "id int, data_quality_tag array<string>")
    twice = spark.createDataFrame([(1, []), (1, ["x"])], "id int, data_quality_tag array<string>")
    with pytest.raises(Exception, match="more than one source row"):
        quality.apply_tags(known, twice, ["id"]).count()


# ---------------------------------------------------------------- rules


@pytest.fixture
def columns(spark):
    rows = [
        ("Lake.T.c", "Lake", "T", "c", True, None, False),
        ("Lake.T.d", "Lake", "T", "d", None, 3, False),
        ("Lake.T.e", "Lake", "T", "e", True, 4, True),
        ("Lake.T.f", "Lake", "T", "f", False, None, False),
        ("Lake.T.g", "Lake", "T", "g", True, 2, None),
        ("Lake.U.c", "Lake", "U", "c", True, 5, False),
    ]
    return spark.createDataFrame(
        rows,
        "column_id string, database string, table string, column_name string, "
        "null_test boolean, length_test int, is_deleted boolean",
    )


def test_rules_from_dictionary(columns):
    nulls, lengths = rules.null_rules(columns), rules.length_rules(columns)
    assert sorted(r.test_name for r in nulls.collect()) == ["Lake.T.c.is_null", "Lake.U.c.is_null"]
    assert sorted(r.test_name for r in lengths.collect()) == [
        "Lake.T.d.is_not_length_3",
        "Lake.U.c.is_not_length_5",
    ]
    # picked in any letter case
    assert rules.compile_rules(nulls, lengths, "LAKE", "t") == [
        Rule("Lake.T.c.is_null", "c"),
        Rule("Lake.T.d.is_not_length_3", "d", 3),
    ]
    assert rules.compile_rules(nulls, lengths, "lake", "other") == []


def test_rule_result(spark):
    df = spark.createDataFrame([("ab",), ("abc",), (None,)], "s string")
    got = [r[0] for r in df.select(Rule("len", "s", 3).result).collect()]
    assert got == ["len", "PASS", "PASS"]


def test_resolve_key(spark):
    tables = spark.createDataFrame(
        [("Lake", "T", "a; b"), ("Lake", "U", None)], "database string, table string, Key string"
    )
    assert rules.resolve_key(tables, "lake", "t") == ["a", "b"]
    for table in ("u", "missing"):
        with pytest.raises(KeyError):
            rules.resolve_key(tables, "lake", table)


def test_configure(spark, columns):
    changed = rules.set_null_test(rules.set_length_test(columns, ["c"], 9), ["d", "f"])
    got = {r.column_id: (r.null_test, r.length_test) for r in changed.collect()}
    assert got["Lake.T.c"] == (True, 9) and got["Lake.U.c"] == (True, 9)
    assert got["Lake.T.d"] == (True, 3) and got["Lake.T.f"] == (True, None)
    tables = spark.createDataFrame([("T", None), ("U", "x")], "table string, Key string")
    keyed = {r.table: r.Key for r in rules.set_key(tables, ["T"], ["a", "b"]).collect()}
    assert keyed == {"T": "a;b", "U": "x"}


def test_tag_states_survive_storage(spark, fact, tmp_path):
    path = str(tmp_path / "quality")
    quality.tag_keys(fact, RULES, ["id"]).write.parquet(path)
    back = spark.read.parquet(path)
    assert back.where(F.size(quality.TAG) == 0).count() == 2
