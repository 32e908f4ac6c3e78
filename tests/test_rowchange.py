"""Merge family: NULL keys, copies on either side, scope, split of frequent keys."""

import contextlib
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablecheck.operators import quality, rowchange, skew
from tablecheck.operators.rules import Rule

T_SCHEMA = "k bigint, v string, n int"
S_SCHEMA = "k bigint, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def upsert(t, s, **options):
    return rowchange.merge(
        t, s, ["k"], matched={"v": "v"}, not_matched={"k": "k", "v": "v"}, **options
    )


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 1), (2, "b", 2), (2, "b2", 3), (None, "z", 4)], T_SCHEMA
    )


@pytest.fixture
def source(spark):
    # key 2 has two target rows, key 3 is new and comes twice, NULL never matches
    return spark.createDataFrame([(2, "B"), (3, "C"), (3, "C"), (None, "Z")], S_SCHEMA)


@pytest.mark.parametrize("split", [False, True])
def test_upsert(target, source, split):
    merged = upsert(target, source, split_hot=split)
    assert merged.schema.simpleString() == target.schema.simpleString()
    assert rows(merged) == sorted(
        [
            (1, "a", 1),
            (2, "B", 2),
            (2, "B", 3),
            (None, "z", 4),
            (3, "C", None),
            (3, "C", None),
            (None, "Z", None),
        ],
        key=repr,
    )


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("action", ["collect", "count"])
def test_two_source_rows_for_one_target_row(spark, target, split, action):
    twice = spark.createDataFrame([(1, "x"), (1, "y")], S_SCHEMA)
    with pytest.raises(Exception, match="more than one source row"):
        getattr(upsert(target, twice, split_hot=split), action)()
    with pytest.raises(Exception, match="more than one source row"):
        matched_only = rowchange.merge(target, twice, ["k"], {"v": "v"}, split_hot=split)
        getattr(matched_only, action)()
    # an insert never updates twice
    assert rowchange.merge(target, twice, ["k"], None, "*", split_hot=split).count() == 4


def test_matched_only_and_insert_only(target, source):
    assert rows(rowchange.merge(target, source, ["k"], {"n": F.col("t.n") + F.length("s.v")})) == (
        sorted([(1, "a", 1), (2, "b", 3), (2, "b2", 4), (None, "z", 4)], key=repr)
    )
    added = rowchange.merge(target, source, ["k"], None, "*")
    assert added.count() == 7
    assert rowchange.merge(target, source, ["k"]).count() == 4


def test_insert_star_fills_missing_columns(spark, target):
    new = spark.createDataFrame([("C", 9)], "v string, k int")
    merged = rowchange.merge(target, new, ["k"], {}, "*")
    assert (9, "C", None) in rows(merged)


def test_other_key_names_and_odd_columns(spark):
    t = spark.createDataFrame([(1, "x")], "`row-id` int, `a.b` string")
    s = spark.createDataFrame([(1, "y"), (2, "z")], "other bigint, val string")
    merged = rowchange.merge(
        t, s, {"row-id": "other"}, {"a.b": "val"}, {"row-id": "other", "a.b": "val"}
    )
    assert rows(merged) == [(1, "y"), (2, "z")]


def test_unknown_column(target, source):
    with pytest.raises(ValueError, match="nope"):
        rowchange.merge(target, source, ["k"], {"nope": "v"})


def test_update_where(target):
    out = rowchange.update_where(
        target, F.col("k") > 1, {"v": F.concat("v", F.lit("!")), "k": F.col("n") * 10}
    )
    assert rows(out) == sorted(
        [(1, "a", 1), (20, "b!", 2), (30, "b2!", 3), (None, "z", 4)], key=repr
    )


DICT_SCHEMA = "db string, t string, is_deleted boolean, keep int"


@pytest.fixture
def dictionary(spark):
    return spark.createDataFrame(
        [
            ("d1", "a", False, 1),
            ("d1", "b", False, 2),
            ("d1", "c", True, 3),
            ("d2", "a", False, 4),
            ("d1", None, False, 5),
        ],
        DICT_SCHEMA,
    )


@pytest.mark.parametrize("split", [False, True])
def test_soft_delete(spark, dictionary, split):
    seen = spark.createDataFrame([("d1", "a"), ("d1", "a"), (None, "a")], "db string, t string")
    scoped = rowchange.soft_delete(dictionary, seen, ["db", "t"], ["db"], split_hot=split)
    assert {r.keep: r.is_deleted for r in scoped.collect()} == {
        1: False, 2: True, 3: True, 4: False, 5: False
    }
    unscoped = rowchange.soft_delete(dictionary, seen, ["db", "t"], split_hot=split)
    assert {r.keep: r.is_deleted for r in unscoped.collect()} == {
        1: False, 2: True, 3: True, 4: True, 5: False
    }


@pytest.mark.parametrize("split", [False, True])
def test_sync(spark, dictionary, split):
    seen = spark.createDataFrame(
        [("d1", "a", 10), ("d1", "c", 30), ("d3", "x", 60)], "db string, t string, keep int"
    )
    done = rowchange.sync(
        dictionary, seen, ["db", "t"], {"keep": "keep"}, scope=["db"], split_hot=split
    )
    assert rows(done) == sorted(
        [
            ("d1", "a", False, 10),
            ("d1", "b", True, 2),
            ("d1", "c", False, 30),
            ("d2", "a", False, 4),
            ("d1", None, False, 5),
            ("d3", "x", False, 60),
        ],
        key=repr,
    )


def test_sync_equals_upsert_then_soft_delete(spark, dictionary):
    seen = spark.createDataFrame([("d1", "a", 10), ("d2", "q", 7)], "db string, t string, keep int")
    one = rowchange.sync(dictionary, seen, ["db", "t"], {"keep": "keep"}, scope=["db"])
    types = skew.key_types(dictionary, seen, [("db", "db"), ("t", "t")])
    found = skew.hot_hashes(dictionary, skew.key_hash(["db", "t"], types))
    given_hashes = rowchange.sync(
        dictionary, seen, ["db", "t"], {"keep": "keep"}, scope=["db"], split_hot=[*found, 1]
    )
    assert rows(given_hashes) == rows(one)
    two = rowchange.soft_delete(
        rowchange.merge(
            dictionary,
            seen,
            ["db", "t"],
            {"keep": "keep", "is_deleted": F.lit(False)},
            {"db": "db", "t": "t", "keep": "keep", "is_deleted": F.lit(False)},
        ),
        seen,
        ["db", "t"],
        ["db"],
    )
    assert rows(one) == rows(two)


keys = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(keys, st.sampled_from("ab"), st.integers(0, 3)), max_size=12),
    st.dictionaries(st.integers(0, 8), st.sampled_from("xy"), max_size=6),
    st.integers(0, 3),
)
def test_merge_properties(spark, target_rows, source_rows, nulls):
    t = spark.createDataFrame(target_rows, T_SCHEMA)
    s = spark.createDataFrame([*source_rows.items(), *[(None, "n")] * nulls], S_SCHEMA)
    known = {k for k, _, _ in target_rows if k is not None}
    want = [(k, source_rows.get(k, v), n) for k, v, n in target_rows]
    want += [(k, v, None) for k, v in source_rows.items() if k not in known]
    want += [(None, "n", None)] * nulls
    for split in (False, True):
        merged = upsert(t, s, split_hot=split)
        assert rows(merged) == sorted(want, key=repr)
    # merging again changes nothing for keys that are set
    again = upsert(merged, s.where("k IS NOT NULL"))
    assert rows(again) == sorted(want, key=repr)


# ---------------------------------------------------------------- frequent keys


def test_hot_keys_are_found_exactly(spark):
    df = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -7 WHEN id % 3 = 1 THEN NULL ELSE id END AS k"
    )
    types = skew.key_types(df, df, [("k", "k")])
    found = skew.hot_hashes(df, skew.key_hash(["k"], types))
    hot = df.select(skew.key_hash(["k"], types).alias("h"), "k").where(F.col("h").isin(found))
    assert {r.k for r in hot.select("k").distinct().collect()} == {-7, None}
    assert skew.hot_hashes(spark.range(9000).toDF("k"), skew.key_hash(["k"], types)) == []


def test_keys_of_different_types_meet_in_the_split(spark):
    key = "CAST(CASE WHEN id < 1000 THEN -0.0D ELSE id END AS DOUBLE) AS k"
    t = spark.range(3000).selectExpr(key, "'t' AS v", "1 AS n")
    s = spark.createDataFrame([(0, "s"), (2000, "s")], "k int, v string")
    merged = rowchange.merge(t, s, ["k"], {"v": "v"}, split_hot=True)
    assert merged.where("v = 's'").count() == 1001


def test_hot_branch_is_broadcast_and_cold_branch_shuffled(spark, tmp_path):
    df = spark.range(20000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS v")
    df.write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    s = spark.range(-1, 20000).selectExpr("id AS k", "id * 2 AS v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = rowchange.merge(t, s, ["k"], {"v": "v"}, split_hot=True)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert merged.where("k = -1 AND v = -2").count() == 6667
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_measured_keys_are_passed_on(spark, tmp_path):
    path = str(tmp_path / "keys")
    spark.range(30_000).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id AS v").write.parquet(path)
    t = spark.read.parquet(path)
    found = skew.measure_keys(t, ["k"])
    assert found.total == 30_000 and list(found.counts.values()) == [10_000]
    other = skew.FrequentKeys(5, {1: 3})
    assert (found | other).counts == {**found.counts, 1: 3} and (found | other).total == 30_000
    s = spark.range(-1, 100).selectExpr("id AS k", "id * 2 AS v")
    with jobs(spark) as started:
        merged = rowchange.merge(t, s, ["k"], {"v": "v"}, "*", split_hot=found)
    assert not started()
    assert merged.where("k = -1 AND v = -2").count() == 10_000
    assert rows(merged) == rows(rowchange.merge(t, s, ["k"], {"v": "v"}, "*"))


@contextlib.contextmanager
def jobs(spark):
    """What is called afterwards gives the Spark jobs that were started inside."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    yield lambda: list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup(uuid.uuid4().hex, "not counted")


def test_operators_start_no_job_while_planning(spark, tmp_path):
    t = stored_rows(spark, tmp_path, "t", [(1, "a", 1), (2, "b", 2), (None, "z", 4)], T_SCHEMA)
    t = t.withColumn("is_deleted", F.lit(False)).join(t.select("k"), "k", "left")
    s = stored_rows(spark, tmp_path, "s", [(2, "B"), (3, "C"), (3, "C"), (None, "Z")], S_SCHEMA)
    rules_ = [Rule("v", "v")]
    with jobs(spark) as started:
        made = [
            rowchange.merge(t, s, ["k"], {"v": "v"}, "*"),
            rowchange.merge(t, s, ["k"], {"v": "v"}),
            rowchange.merge(t, s, ["k"], None, "*"),
            rowchange.soft_delete(t, s, ["k"], ["v"]),
            rowchange.sync(t, s, ["k"], {"v": "v"}, scope=["v"]),
            quality.seed_quality(s, quality.tag_keys(s, rules_, ["k"]), ["k"]),
            quality.apply_tags(quality.tag_keys(s, rules_, ["k"]), quality.tag_keys(s, rules_, ["k"]), ["k"]),
            quality.refresh_quality(s, quality.tag_keys(s, rules_, ["k"]), rules_, ["k"]),
        ]
    assert not started() and all(df.columns for df in made)


def test_spark_splits_a_frequent_key(spark, tmp_path):
    """Without any split of ours, no task of the join gets much more than its share."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    path = str(tmp_path / "t")
    hot = spark.range(0, 400_000, 1, 8).selectExpr("IF(id % 3 = 0, -1, id) AS k", "sha(string(id)) AS v")
    hot.withColumn("is_deleted", F.lit(False)).write.parquet(path)
    t = spark.read.parquet(path)
    s = spark.range(-1, 400_000).selectExpr("id AS k", "'new' AS v")
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for made in (
            rowchange.merge(t, s, ["k"], {"v": "v"}),
            rowchange.merge(t, s, ["k"], {"v": "v"}, "*"),
            rowchange.sync(t, s, ["k"], {"v": "v"}),
            rowchange.soft_delete(t, s, ["k"]),
        ):
            out = made.select("k", "v", F.spark_partition_id().alias("task"))
            counted = out.where("k = -1").groupBy("task").agg(F.count(F.substring("v", 1, 1)).alias("n"))
            sizes = [r["n"] for r in counted.collect()]
            assert sum(sizes) == 133_334 and len(sizes) >= 4 and max(sizes) < 400_000 / 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_more_tasks_find_rarer_keys(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 10_000)
    try:
        df = spark.range(60_000).selectExpr("IF(id < 10, -1, id) AS k")
        assert len(skew.hot_hashes(df, skew.key_hash(["k"], [df.schema["k"].dataType]))) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def stored_rows(spark, tmp_path, name, rows_, schema):
    path = str(tmp_path / name)
    spark.createDataFrame(rows_, schema).write.parquet(path)
    return spark.read.parquet(path)


def test_small_source_leaves_the_target_in_place(spark, tmp_path):
    t = stored_rows(spark, tmp_path, "t", [(1, "a", 1), (2, "b", 2), (2, "c", 3), (None, "z", 4)], T_SCHEMA)
    s = stored_rows(spark, tmp_path, "s", [(2, "B"), (3, "C"), (3, "C"), (None, "Z")], S_SCHEMA)
    merged = upsert(t, s)
    assert rows(merged) == rows(upsert(t, s, split_hot=False))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Exchange hashpartitioning" not in plan.split("Union", 1)[1].split("BroadcastExchange")[0]
    with pytest.raises(Exception, match="more than one source row"):
        upsert(t, stored_rows(spark, tmp_path, "s2", [(2, "x"), (2, "y")], S_SCHEMA)).count()
    flagged = t.withColumn("is_deleted", F.lit(False))
    one, two = (
        rowchange.sync(flagged, s.distinct(), ["k"], {"v": "v"}, split_hot=how)
        for how in (None, False)
    )
    assert rows(one) == rows(two)


def test_rows_without_a_full_key_are_not_dealt_to_one_task(spark):
    left = spark.createDataFrame([(None, n) for n in range(50)] + [(7, 0), (7, 1)], "id long, v long")
    right = spark.createDataFrame([(7, 1), (None, 2)], "id long, v long")
    t, s, _ = skew.spread(left, right, [("id", "id")])
    hashes = {r["id"]: r["n"] for r in t.groupBy("id").agg(F.count_distinct("__key_hash").alias("n")).collect()}
    assert hashes == {None: 50, 7: 1}
    safe, s, _ = skew.spread(left, right, [("id", "id")], null_safe=True)
    own = safe.where("id IS NULL").select("__key_hash").distinct().collect()
    assert own == s.where("id IS NULL").select("__key_hash").collect()
    merged = rowchange.merge(left, right, ["id"], {"v": "v"}, "*")
    assert merged.where("id IS NULL").count() == 51 and merged.where("id = 7 AND v = 1").count() == 2
