"""Increment-only upserts, versioned replacement and the delivery ledger: contents, the
files a step may touch, and what a failure at any step leaves."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerkit.operators import increments, versions
from layerkit.operators.increments import compact, latest, load_increment
from layerkit.operators.merge import upsert_into_table
from layerkit.operators.versions import publish, read_published, replace_partitions, replace_table
from layerkit.plans import incremental as inc
from layerkit.plans import medallion as med
from layerkit.session import new_database, new_run_dir
from layerkit.sources import folders
from tests.conftest import SF_SMALL

DDL = "k BIGINT, part STRING, t TIMESTAMP_NTZ, v STRING"
KEY = ["k", "part"]


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def rows(spark, *items):
    return spark.createDataFrame([(k, p, None if d is None else day(d), v) for k, p, d, v in items], DDL)


def content(df):
    return sorted(map(repr, ((r["k"], r["part"], r["t"], r["v"]) for r in df.collect())))


def files(spark, table):
    db, name = table.split(".")
    root = spark.catalog.getDatabase(db).locationUri
    return {f: s for f in folders.data_files(spark, f"{root}/_{name}_versions") for s in [f]}


@pytest.fixture
def table(spark):
    return f"{new_database(spark, 't_inc')}.t"


def test_repeated_and_null_keys_from_the_first_load_on(spark, table):
    load_increment(spark, table, rows(spark, (1, "a", 0, "x"), (1, "a", 0, "y"), (None, "a", 1, "x"), (None, "a", 1, "z"), (2, None, None, "n")), KEY, "t")
    assert content(latest(spark, table, KEY)) == content(rows(spark, (1, "a", 0, "y"), (None, "a", 1, "z"), (2, None, None, "n")))
    again = rows(spark, (None, "a", 3, "later"), (2, None, None, "m"))
    for _ in range(2):  # a replay changes nothing
        load_increment(spark, table, again, KEY, "t")
        assert content(latest(spark, table, KEY)) == content(rows(spark, (1, "a", 0, "y"), (None, "a", 3, "later"), (2, None, None, "m")))


def test_bucketed_upsert_reduces_its_first_load(spark):
    table = f"{new_database(spark, 't_up')}.t"
    upsert_into_table(spark, table, rows(spark, (1, "a", 0, "x"), (1, "a", 0, "y"), (None, "a", 1, "x"), (None, "a", 1, "z")), KEY, buckets=4)
    assert content(spark.table(table)) == content(rows(spark, (1, "a", 0, "y"), (None, "a", 1, "z")))


def test_an_increment_writes_its_own_files_only_and_compaction_its_grains(spark, table):
    base = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("part"),
                                    (F.lit(day(0)).cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 20).cast("int"))).alias("t"),
                                    F.lit("base").alias("v"))
    load_increment(spark, table, base, KEY, "t")
    before = files(spark, table)
    assert len(before) == 20
    # ten rows stay on their day (3), one moves from day 5 to day 40
    delta = rows(spark, *[(k, "a", 3, "new") for k in range(3, 203, 20)], (5, "a", 40, "moved"))
    load_increment(spark, table, delta, KEY, "t")
    after = files(spark, table)
    assert set(before) < set(after) and len(after) - len(before) == 2
    want = content(base.join(delta, KEY, "left_anti").unionByName(delta))
    assert content(latest(spark, table, KEY)) == want
    assert compact(spark, table, KEY) == ["2024-01-04", "2024-01-06", "2024-02-10"]
    assert content(latest(spark, table, KEY)) == want
    left = files(spark, table)
    assert {f for f in before if f not in left} == {f for f in before if "_grain=2024-01-04" in f or "_grain=2024-01-06" in f}
    assert not [f for f in left if "_kind=delta" in f]
    assert "Window" not in latest(spark, table, KEY)._jdf.queryExecution().toString()
    assert compact(spark, table, KEY) == []


def test_a_grain_that_loses_all_rows_is_empty_after_compaction(spark, table):
    load_increment(spark, table, rows(spark, (1, "a", 0, "x"), (2, "a", 1, "x")), KEY, "t")
    load_increment(spark, table, rows(spark, (1, "a", 9, "moved")), KEY, "t")
    compact(spark, table, KEY)
    assert content(latest(spark, table, KEY)) == content(rows(spark, (1, "a", 9, "moved"), (2, "a", 1, "x")))
    load_increment(spark, table, rows(spark, (3, "a", 0, "back")), KEY, "t")
    assert content(latest(spark, table, KEY)) == content(rows(spark, (1, "a", 9, "moved"), (2, "a", 1, "x"), (3, "a", 0, "back")))


@pytest.mark.parametrize("step", ["load", "compact", "clean-up"])
def test_a_failed_step_leaves_the_last_state_readable(spark, table, monkeypatch, step):
    load_increment(spark, table, rows(spark, (1, "a", 0, "x"), (2, "a", 1, "x")), KEY, "t")
    load_increment(spark, table, rows(spark, (2, "a", 1, "y")), KEY, "t")
    want = content(rows(spark, (1, "a", 0, "x"), (2, "a", 1, "y")))

    def broken(*_, **__):
        raise RuntimeError("lost")

    real_add = increments.add_partitions
    if step == "clean-up":
        calls = []
        real_drop = increments._drop
        monkeypatch.setattr(increments, "_drop", lambda *a: broken() if calls else calls.append(real_drop(*a)))
    else:  # the files and partitions are there, the number is not raised
        monkeypatch.setattr(increments, "add_partitions", lambda *a: (real_add(*a), broken()))
    with pytest.raises(RuntimeError):
        if step == "load":
            load_increment(spark, table, rows(spark, (1, "a", 0, "half"), (9, "a", 0, "half")), KEY, "t")
        else:
            compact(spark, table, KEY)
    monkeypatch.undo()
    assert content(latest(spark, table, KEY)) == want
    load_increment(spark, table, rows(spark, (3, "a", 0, "next")), KEY, "t")
    assert content(latest(spark, table, KEY)) == sorted(want + content(rows(spark, (3, "a", 0, "next"))))
    compact(spark, table, KEY)
    assert content(latest(spark, table, KEY)) == sorted(want + content(rows(spark, (3, "a", 0, "next"))))


def test_published_versions_switch_last(spark, monkeypatch):
    root = new_run_dir(spark, "t_marks")
    spark.createDataFrame([("t", day(0))], inc.WATERMARK_DDL).write.parquet(root)  # a plain folder is version 0
    inc.set_marks(spark, root, {"t": day(1), "u": day(2)})
    assert inc.read_marks(spark, root) == {"t": day(1), "u": day(2)}

    def broken(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions.folders, "write_text", broken)
    with pytest.raises(RuntimeError):
        inc.set_marks(spark, root, {"t": day(9)})
    monkeypatch.undo()
    assert inc.read_marks(spark, root) == {"t": day(1), "u": day(2)}
    for n in range(4):
        publish(spark.range(n), root)
    assert read_published(spark, root).count() == 3
    assert len([f for f in folders.children(spark, f"{root}-versions") if "/v-" in f]) == 2


def test_replaced_tables_and_partitions_switch_last(spark, monkeypatch):
    db = new_database(spark, "t_rep")
    small, big = f"{db}.small", f"{db}.big"
    replace_table(spark.range(5), small)
    replace_table(spark.table(small).where("id > 2"), small)  # computed from the table it replaces
    assert sorted(r.id for r in spark.table(small).collect()) == [3, 4]
    spark.sql(f"CREATE TABLE {big} (k BIGINT, p STRING) USING parquet PARTITIONED BY (p)")
    spark.range(9).selectExpr("id k", "CASE WHEN id % 3 < 2 THEN concat('p ', id % 3) END p").write.insertInto(big)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    replace_partitions(spark.table(big).where("p IS NULL").selectExpr("k + 100 k", "p"), big, ["p"])
    assert sorted(r.k for r in spark.table(big).collect()) == [0, 1, 3, 4, 6, 7, 102, 105, 108]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode

    real = spark.sql

    def broken(text, *a, **k):
        if text.startswith("ALTER TABLE"):
            raise RuntimeError("lost")
        return real(text, *a, **k)

    for replace in (lambda: replace_table(spark.range(1), small), lambda: replace_partitions(spark.table(big).where("p = 'p 0'").limit(1), big, ["p"])):
        with monkeypatch.context() as m:
            m.setattr(spark, "sql", broken)
            m.setattr(type(spark), "sql", lambda self, text, *a, **k: broken(text, *a, **k))
            with pytest.raises(RuntimeError):
                replace()
    assert spark.table(small).count() == 2 and spark.table(big).count() == 9


def delivered(spark, run, records, when, name):
    path = f"{run.root}/{name}"
    med.write_raw_documents(spark, SF_SMALL, path, records=records)
    med.raw_to_bronze(spark, path, run.bronze, when, run.ledger)


def test_redelivered_documents_are_taken_once(spark, monkeypatch):
    run = med.MedallionRun(spark, SF_SMALL)
    records = med.movie_records(spark, SF_SMALL)
    delivered(spark, run, records.where("Id % 2 = 0"), dt.datetime(2024, 1, 15, 8), "one")
    run.to_silver()
    n = spark.table(run.bronze).count()
    assert n == records.where("Id % 2 = 0").count()
    # the next day brings the same records and some more; the job dies before the ledger is written
    real = med.enter_ledger
    monkeypatch.setattr(med, "enter_ledger", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        delivered(spark, run, records.where("Id % 2 = 0 OR Id % 5 = 0"), dt.datetime(2024, 1, 16, 8), "two")
    monkeypatch.setattr(med, "enter_ledger", real)
    delivered(spark, run, records.where("Id % 2 = 0 OR Id % 5 = 0"), dt.datetime(2024, 1, 17, 8), "three")
    delivered(spark, run, records, dt.datetime(2024, 1, 18, 8), "four")
    assert spark.table(run.bronze).count() == records.count()
    run.to_silver()
    delivered(spark, run, records, dt.datetime(2024, 1, 19, 8), "five")
    assert spark.table(run.bronze).where("Status = 'New'").count() == 0
    keys = spark.table(run.ledger).select("record_key")
    assert keys.count() == keys.distinct().count() == records.distinct().count()
    both = spark.table(run.silver).select("record_key").union(spark.table(run.quarantine).select("record_key"))
    assert both.count() == keys.count()


def test_repair_leaves_other_days_of_quarantine_alone(spark):
    run = med.MedallionRun(spark, SF_SMALL)
    records = med.movie_records(spark, SF_SMALL)
    broken = records.where("RunTime IS NULL")  # cannot be repaired
    delivered(spark, run, broken, dt.datetime(2024, 1, 15, 8), "one")
    run.to_silver()
    delivered(spark, run, records, dt.datetime(2024, 1, 16, 8), "two")
    run.to_silver()
    old = {f for f in spark.table(run.quarantine).where("p_Ingestdate = DATE '2024-01-15'").inputFiles()}
    run.repair()
    assert set(spark.table(run.quarantine).where("p_Ingestdate = DATE '2024-01-15'").inputFiles()) == old
    assert spark.table(run.quarantine).where("RunTime < 0 AND ReleaseDate IS NOT NULL").count() == 0
