"""File-level deletes, action-driven merges and the heavy-key join."""
import pytest
from pyspark.sql import functions as F

from layerkit.operators import rewrite
from layerkit.operators.joins import skew_join
from layerkit.operators.merge import apply_actions, apply_actions_to
from layerkit.operators.rewrite import delete_matching, delete_where_in, finish_rewrite, read_files
from layerkit.session import new_database, new_run_dir
from layerkit.sources import folders


@pytest.fixture
def path(spark):
    p = f"{new_run_dir(spark, 't_files')}/rows"
    df = spark.range(1000).select(F.when(F.col("id") % 100 != 7, F.col("id")).alias("k"), (F.col("id") % 3).alias("p"), F.lit("x").alias("v"))
    df.repartitionByRange(10, "k").write.partitionBy("p").parquet(p)
    return p


def stamps(spark, path):
    fs = rewrite.folders._fs(spark, path)
    out = {}
    for f in folders.data_files(spark, path):
        s = fs.getFileStatus(rewrite.folders._path(spark, f))
        out[f] = (s.getLen(), s.getModificationTime())
    return out


def test_a_deletion_request_leaves_all_other_files_unchanged(spark, path):
    before = stamps(spark, path)
    requests = spark.createDataFrame([(5,), (8,), (11,), (5,), (100000,), (None,)], "key long")
    old = delete_matching(spark, path, "k", requests)
    after = stamps(spark, path)
    assert 0 < len(old) < len(before) / 4
    assert {f: s for f, s in before.items() if f not in after} .keys() == set(old) & set(before)
    assert all(after[f] == before[f] for f in before if f in after)
    left = read_files(spark, path)
    assert left.count() == 997 and left.where("k in (5, 8, 11)").count() == 0 and left.where("k is null").count() == 10
    assert left.groupBy("p").count().count() == 3
    assert delete_matching(spark, path, "k", requests) == [] and stamps(spark, path) == after


def test_delete_where_keeps_null_results_and_drops_emptied_files(spark, path):
    n = len(folders.data_files(spark, path))
    delete_where_in(spark, path, F.col("k") < 500)
    left = read_files(spark, path)
    assert sorted(r.k for r in left.where("k is not null").collect()) == [k for k in range(500, 1000) if k % 100 != 7]
    assert left.where("k is null").count() == 10 and len(folders.data_files(spark, path)) < n


@pytest.mark.parametrize("step", ["before the intent", "after it", "half moved"])
def test_an_interrupted_delete_is_undone_or_finished(spark, path, monkeypatch, step):
    def broken(*_, **__):
        raise RuntimeError("lost")

    real = {"write_text": folders.write_text, "remove": folders.remove, "move": folders.move}
    if step == "before the intent":
        monkeypatch.setattr(rewrite.folders, "write_text", broken)
    elif step == "after it":
        monkeypatch.setattr(rewrite.folders, "move", lambda s, a, b, **k: broken() if "/new/" in a else real["move"](s, a, b, **k))
    else:
        monkeypatch.setattr(rewrite.folders, "remove", lambda s, p: real["remove"](s, p) if p.endswith(rewrite.AREA) else broken())
    with pytest.raises(RuntimeError):
        delete_where_in(spark, path, F.col("k") < 30)
    monkeypatch.undo()
    if step == "before the intent":
        assert spark.read.parquet(path).count() == 1000
        assert not finish_rewrite(spark, path) and spark.read.parquet(path).count() == 1000
    else:
        assert read_files(spark, path).where("k < 30").count() == 0
        assert read_files(spark, path).count() == 1000 - 29
    delete_where_in(spark, path, F.col("k") < 30)
    assert read_files(spark, path).count() == 1000 - 29


ROWS = "k LONG, p STRING, v STRING"


def test_actions_in_one_pass(spark):
    target = spark.createDataFrame([(1, "a", "old"), (2, "a", "old"), (3, "b", "old"), (4, "b", "old"), (None, "b", "old")], ROWS)
    marked = spark.createDataFrame(
        [(1, "a", "new", "update", 0), (2, "a", "x", "delete", 0), (3, "b", "no", "insert", 0), (9, "c", "in", "insert", 0),
         (8, "c", "no", "update", 0), (7, "c", "no", "delete", 0), (4, "c", "moved", "upsert", 0), (6, "c", "up", "upsert", 0),
         (None, "b", None, "update", 0), (5, "c", "first", "insert", 1), (5, "c", "second", "insert", 2)], ROWS + ", _action STRING, n INT")
    out = apply_actions(target, marked, "k", order_by=["n"])
    assert out.columns == target.columns
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [
        (1, "a", "new"), (3, "b", "old"), (4, "c", "moved"), (5, "c", "second"), (6, "c", "up"), (9, "c", "in"), (None, "b", None)]))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join FullOuter") == 1
    with pytest.raises(Exception, match="unknown action"):
        apply_actions(target, marked.withColumn("_action", F.lit("drop")), "k").collect()


def test_actions_touch_only_their_partitions(spark):
    table = f"{new_database(spark, 't_act')}.t"
    spark.sql(f"CREATE TABLE {table} (k LONG, v STRING, p STRING) USING parquet PARTITIONED BY (p)")
    rows = [(i, "old", "abc"[i % 3]) for i in range(9)]
    spark.createDataFrame(rows, "k LONG, v STRING, p STRING").write.insertInto(table)
    other = spark.table(table).where("p = 'c'").inputFiles()
    marked = spark.createDataFrame([(0, "b", "moved", "update"), (3, "a", "", "delete"), (6, "a", "", "delete"), (20, "d", "new", "insert")], ROWS + ", _action STRING")
    apply_actions_to(spark, table, marked, "k")
    want = [(k, v, p) for k, v, p in rows if p != "a"] + [(0, "moved", "b"), (20, "new", "d")]
    assert sorted(tuple(r) for r in spark.table(table).select("k", "v", "p").collect()) == sorted(want)
    assert spark.table(table).where("p = 'c'").inputFiles() == other
    assert sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()) == ["p=b", "p=c", "p=d"]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_heavy_key_join_equals_the_plain_one(spark, how):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    right = spark.range(0, 2000, 2).select(F.col("id").alias("rk"), F.lit("r").alias("v")).union(spark.createDataFrame([(7, "hot"), (7, "hot2"), (None, "no")], "rk long, v string"))
    got = skew_join(left, right, [("k", "rk")], how, share=0.05, spread=8)
    want = left.join(right, F.col("k") == F.col("rk"), how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_heavy_key_join_spreads_its_heavy_key_without_broadcasting_a_side(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
        right = spark.range(5000).select(F.col("id").alias("rk"))
        out = skew_join(left, right, [("k", "rk")], share=0.1, spread=16)
        tasks = [r["count"] for r in out.where("k = 7").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 2001 and max(tasks) < 1000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 2  # the bounded key list only
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("n, m", [(2000, 2000), (4000, 50), (50, 4000)])
def test_heavy_key_join_repeats_few_rows_of_either_side(spark, monkeypatch, n, m):
    moved, repartition = [], type(spark.range(0)).repartition
    monkeypatch.setattr(type(spark.range(0)), "repartition", lambda df, *a: moved.append(df) or repartition(df, *a))
    left = spark.range(n).select(F.lit(7).alias("k"), F.col("id").alias("n")).union(spark.createDataFrame([(1, 1), (None, 2)], "k int, n long"))
    right = spark.range(m).select(F.lit(7).alias("rk"), F.col("id").alias("m")).union(spark.createDataFrame([(1, 1), (None, 2)], "rk int, m long"))
    out = skew_join(left, right, [("k", "rk")], spread=2, pairs=n * m // 400)
    assert out.groupBy("k", "n", "m").count().where("count > 1").isEmpty() and out.count() == n * m + 1
    assert len(moved) == 2 and sum(df.count() for df in moved) < 2.2 * (400 * n * m) ** 0.5 + n + m  # one-sided: 400 * m


def test_only_heavy_keys_are_listed(spark, monkeypatch):
    listed, broadcast = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: listed.append(df) or broadcast(df))
    left = spark.range(4000).select(F.when(F.col("id") < 100, F.lit(7)).otherwise(F.col("id") % 400).alias("k"), F.col("id").alias("n"))
    right = spark.range(400).select(F.col("id").alias("rk"))
    assert skew_join(left, right, [("k", "rk")], share=0.02).count() == 4000
    assert {tuple(r) for df in listed for r in df.select("__h0").collect()} == {(7,)}
