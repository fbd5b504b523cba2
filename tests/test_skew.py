"""Operators stay exact when one key holds a third of all rows."""
import random

from pyspark.sql import functions as F

from layerkit.operators import (anti_join_not_in, dedup_keep_first, merge_update, or_join,
                                split_chunks, top_per_group)

N = 6000


def _skewed(spark, seed=11):
    rnd = random.Random(seed)
    rows = [(i, 0 if i % 3 == 0 else rnd.randrange(1, 200), rnd.randrange(0, 50)) for i in range(N)]
    return spark.createDataFrame(rows, "id INT, k INT, v INT"), rows


def test_top_per_group_hot_key(spark):
    df, rows = _skewed(spark)
    best = {}
    for _, k, v in rows:
        best[k] = max(best.get(k, -1), v)
    exp = sorted((i, k) for i, k, v in rows if v == best[k])
    got = sorted(tuple(r) for r in top_per_group(df, ["k"], "v").select("id", "k").collect())
    assert got == exp


def test_dedup_hot_key(spark):
    df, rows = _skewed(spark)
    first = {}
    for i, k, v in sorted(rows, key=lambda r: (r[2], r[0])):
        first.setdefault(k, i)
    got = dict((r.k, r.id) for r in dedup_keep_first(df, ["k"], ["v", "id"]).collect())
    assert got == first


def test_or_join_hot_key(spark):
    df, rows = _skewed(spark)
    right = spark.createDataFrame([(0, 5), (1, 7), (500, 9)], "rk INT, rv INT")
    got = or_join(df, right, [("k", "rk"), ("v", "rv")], how="inner").count()
    exp = sum(1 for _, k, v in rows for rk, rv in [(0, 5), (1, 7), (500, 9)] if k == rk or v == rv)
    assert got == exp


def test_not_in_hot_key(spark):
    df, rows = _skewed(spark)
    excl = spark.createDataFrame([(0,), (3,)], "k INT")
    assert anti_join_not_in(df, excl, "k").count() == sum(1 for r in rows if r[1] not in (0, 3))


def test_merge_update_hot_partition(spark):
    df, rows = _skewed(spark)
    src = df.filter(F.col("k") == 0).select("id", F.lit(-1).alias("v"))
    out = merge_update(df, src, "id", {"v": "v"})
    assert out.filter(F.col("v") == -1).count() == sum(1 for r in rows if r[1] == 0)
    assert out.count() == N


def test_split_chunks_hot_order_key(spark):
    df, _ = _skewed(spark)
    counts = dict(split_chunks(df, ["k", "id"], 8).groupBy("chunk").count().collect())
    assert counts == {c: N // 8 for c in range(8)}


def test_salted_join_matches_plain_join(spark):
    from layerkit.operators import salted_join
    df, rows = _skewed(spark)
    dim = spark.createDataFrame([(k, f"name{k}") for k in range(0, 150)], "k INT, name STRING")
    for how in ("inner", "left"):
        plain = sorted(tuple(r) for r in df.join(dim, ["k"], how).collect())
        salted = sorted(tuple(r) for r in salted_join(df, dim, ["k"], how, salt=8).collect())
        assert salted == plain


def test_status_update_keeps_a_day_spread_over_tasks(spark, monkeypatch):
    from layerkit.plans import medallion as med
    from layerkit.session import new_database
    bronze = med.create_bronze(spark, new_database(spark, "t_days"))
    rows = spark.range(200).select(F.concat(F.lit("m"), "id").alias("Movies"))
    med.stamp_ingest(rows).select(*spark.table(bronze).columns).write.insertInto(bronze)
    seen, apply_merge = [], med.apply_merge

    def watched(spark, table, columns, content, affected):
        seen.append(content._jdf.queryExecution().executedPlan().toString())
        apply_merge(spark, table, columns, content, affected=affected)
    monkeypatch.setattr(med, "apply_merge", watched)
    keys = spark.table(bronze).where("Movies < 'm2'").select("record_key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        med.update_status(spark, bronze, [(keys, med.LOADED)])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(seen) == 1 and "SortMergeJoin [p_Ingestdate" not in seen[0] and "BroadcastHashJoin [p_Ingestdate" in seen[0]
    assert dict(spark.table(bronze).groupBy("Status").count().collect()) == {"Loaded": 112, "New": 88}


def test_or_join_of_few_files_makes_many_pairs_in_many_tasks(spark):
    left = spark.range(6000).select(F.col("id").alias("a"), (F.col("id") % 1).alias("k")).coalesce(1)
    right = spark.range(3000).select(F.col("id").alias("b"), (F.col("id") % 1).alias("rk")).coalesce(1)
    made = or_join(left, right, [("a", "b"), ("k", "rk")], "left", heavy=True)
    tasks = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 6000 * 3000
    assert max(tasks) < 0.6 * sum(tasks)
