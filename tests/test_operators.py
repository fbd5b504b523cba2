import random

from tests.plan_util import plan_text

from pyspark.sql import functions as F

from layerkit.operators import (add_surrogate_key, anti_join_not_in, continue_key,
                                dedup_keep_first, duplicate_keys, merge_delete, merge_insert,
                                merge_update, merge_upsert, null_profile, or_join, pivot_sum,
                                split_chunks, split_rows, top_per_group)


def _key(t):
    return tuple((v is not None, v if v is not None else 0) for v in t)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)


def test_or_join_matches_brute_force(spark):
    rnd = random.Random(7)
    left = [(i, rnd.choice([1, 2, 3, None]), rnd.choice([10, 20, None])) for i in range(40)]
    right = [(j, rnd.choice([1, 2, 4, None]), rnd.choice([10, 30, None])) for j in range(15)]
    l = spark.createDataFrame(left, "lid INT, la INT, lb INT")
    r = spark.createDataFrame(right, "rid INT, ra INT, rb INT")
    got = rows(or_join(l, r, [("la", "ra"), ("lb", "rb")], how="left"), "lid", "rid")
    exp = []
    for lid, la, lb in left:
        hits = [rid for rid, ra, rb in right
                if (la is not None and la == ra) or (lb is not None and lb == rb)]
        exp += [(lid, h) for h in hits] or [(lid, None)]
    assert got == sorted(exp, key=_key)
    inner = rows(or_join(l, r, [("la", "ra"), ("lb", "rb")], how="inner"), "lid", "rid")
    assert inner == sorted((e for e in exp if e[1] is not None), key=_key)


def test_or_join_plan_has_no_nested_loop(spark):
    l = spark.range(100).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    r = spark.range(50).select(F.col("id").alias("c"), (F.col("id") % 5).alias("d"))
    plan = plan_text(or_join(l, r, [("a", "c"), ("b", "d")]))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_not_in_null_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,), (3,)], "k INT")
    right = spark.createDataFrame([(2,), (5,)], "k INT")
    assert rows(anti_join_not_in(left, right, "k"), "k") == [(1,), (3,)]
    right_null = spark.createDataFrame([(2,), (None,)], "k INT")
    assert anti_join_not_in(left, right_null, "k").count() == 0
    empty = spark.createDataFrame([], "k INT")
    assert rows(anti_join_not_in(left, empty, "k"), "k") == [(1,), (2,), (3,)]


def _trap_rows(spark):
    data = []
    i = 0
    for rt in (120, 0, -95, None):
        for rd in ("2020-01-01", None):
            for mid in (1, None):
                data.append((i, mid, rd, rt))
                i += 1
    return spark.createDataFrame(data, "row INT, Id INT, ReleaseDate STRING, RunTime INT")


def test_split_default_and_strict(spark):
    df = _trap_rows(spark)
    rule = F.col("Id").isNotNull() & F.col("ReleaseDate").isNotNull() & (F.col("RunTime") >= 0)
    ok, bad = split_rows(df, rule)
    assert ok.count() + bad.count() == 16
    assert rows(ok, "Id", "ReleaseDate", "RunTime") == [(1, "2020-01-01", 0), (1, "2020-01-01", 120)]
    s_ok, s_bad = split_rows(df, F.col("RunTime") >= 0, strict=True)
    # null RunTime lands in neither branch; zero is clean
    assert s_ok.count() == 8 and s_bad.count() == 4
    assert s_ok.filter(F.col("RunTime") == 0).count() == 4


def test_top_per_group_ties_and_single(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 5), ("a", 3, 1), ("b", 4, 2), (None, 5, 9), (None, 6, 1)],
        "g STRING, item INT, n INT")
    assert rows(top_per_group(df, ["g"], "n"), "g", "item") == sorted(
        [("a", 1), ("a", 2), ("b", 4), (None, 5)], key=_key)
    one = top_per_group(df, ["g"], "n", ties=False, tiebreak=["item"])
    assert rows(one, "g", "item") == sorted([("a", 1), ("b", 4), (None, 5)], key=_key)


def test_dedup_keep_first(spark):
    df = spark.createDataFrame([(1, "z", 3), (1, "a", 1), (2, "q", 5)], "k INT, v STRING, o INT")
    assert rows(dedup_keep_first(df, ["k"], ["o"]), "k", "v") == [(1, "a"), (2, "q")]


def test_surrogate_key_dense_and_ordered(spark):
    rnd = random.Random(3)
    # one hot value holds a third of the rows
    data = [(rnd.choice(["hot"] * 5 + list("abcdefghij")), i) for i in range(3000)]
    df = spark.createDataFrame(data, "name STRING, id INT")
    out = add_surrogate_key(df, ["name", "id"], "sk", num_partitions=7).collect()
    by_key = sorted(out, key=lambda r: (r.name, r.id))
    assert [r.sk for r in by_key] == list(range(1, 3001))


def test_continue_key(spark):
    existing = spark.createDataFrame([(5,), (41,)], "id INT")
    new = spark.createDataFrame([("x",), ("y",)], "name STRING")
    got = rows(continue_key(new, existing, "id", ["name"], "id"), "id", "name")
    assert got == [(42, "x"), (43, "y")]


def test_split_chunks_drop_and_keep_remainder(spark):
    df = spark.range(0, 21).withColumnRenamed("id", "k")
    counts = dict(split_chunks(df, ["k"], 8, keep_remainder=False).groupBy("chunk").count().collect())
    assert counts == {i: 2 for i in range(8)}
    kept = dict(split_chunks(df, ["k"], 8).groupBy("chunk").count().collect())
    assert kept[7] == 7 and sum(kept.values()) == 21
    few = dict(split_chunks(spark.range(0, 5).withColumnRenamed("id", "k"), ["k"], 8).groupBy("chunk").count().collect())
    assert few == {7: 5}


def test_merges(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k INT, v STRING")
    s = spark.createDataFrame([(2, "B"), (2, "B"), (4, "D")], "k INT, v STRING")
    assert rows(merge_insert(t, s, "k"), "k", "v") == [(1, "a"), (2, "b"), (3, "c"), (4, "D")]
    assert rows(merge_upsert(t, s.dropDuplicates(), "k"), "k", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]
    assert rows(merge_delete(t, s, "k"), "k", "v") == [(1, "a"), (3, "c")]
    upd = merge_update(t, s.withColumn("v", F.when(F.col("k") == 2, None).otherwise(F.col("v"))), "k", {"v": "v"})
    assert rows(upd, "k", "v") == [(1, "a"), (2, None), (3, "c")]


def test_null_profile_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, None)], "a INT, b STRING")
    prof = {r.column_name: (r.null_count, r.row_count) for r in null_profile(df).collect()}
    assert prof == {"a": (1, 3), "b": (2, 3)}
    assert rows(duplicate_keys(df, ["a"]), "a", "n_rows") == [(1, 2)]


def test_pivot_sum(spark):
    df = spark.createDataFrame([("x", 2000, 1), ("x", 2000, 2), ("y", 2001, 5), ("y", 1999, 9)],
                               "g STRING, yr INT, q INT")
    out = pivot_sum(df, ["g"], "yr", [2000, 2001], "q", names=["y2000", "y2001"])
    assert out.columns == ["g", "y2000", "y2001"]
    assert rows(out, "g", "y2000", "y2001") == [("x", 3, None), ("y", None, 5)]


def test_upsert_repeats_without_growing(spark):
    t = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b")], "k INT, v STRING")
    s = spark.createDataFrame([(2, "x"), (2, "y"), (None, "m"), (3, None), (3, "z")], "k INT, v STRING")
    once = merge_upsert(t, s, "k")
    want = {(1, "a"), (2, "y"), (None, "m"), (3, "z")}
    assert {(r.k, r.v) for r in once.collect()} == want and once.count() == 4
    again = merge_upsert(once, s.repartition(3), "k")
    assert {(r.k, r.v) for r in again.collect()} == want and again.count() == 4
