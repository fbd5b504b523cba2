import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerkit.plans import incremental as inc
from layerkit.plans import medallion as med
from layerkit.session import new_database, new_run_dir
from layerkit.sources.tables import load
from layerkit.streaming import stream_new_records
from tests.conftest import SF_SMALL


def test_guarded_daily_load_refuses_repeat(spark):
    db = new_database(spark, "t_ods")
    table = inc.create_ods_orders(spark, db)
    o, l = load(spark, SF_SMALL, "orders"), load(spark, SF_SMALL, "lineitem")
    day = o.agg(F.min("o_orderdate")).first()[0].date()
    inc.load_orders_for_date(spark, table, o, l, day)
    n = spark.table(table).count()
    assert n > 0
    with pytest.raises(inc.DateAlreadyLoaded):
        inc.load_orders_for_date(spark, table, o, l, day)
    assert spark.table(table).count() == n


def test_window_load_conflict_and_retention(spark):
    db = new_database(spark, "t_ods")
    table = inc.create_ods_orders(spark, db)
    o, l = load(spark, SF_SMALL, "orders"), load(spark, SF_SMALL, "lineitem")
    days = sorted({r[0].date() for r in o.select("o_orderdate").distinct().orderBy("o_orderdate").limit(4).collect()})
    for d in days[:2]:
        inc.load_orders_for_date(spark, table, o, l, d)
    before = spark.table(table).count()
    with pytest.raises(inc.KeyConflict):
        inc.load_orders_window(spark, table, o, l, days[0], include_start=True, on_conflict="error")
    assert spark.table(table).filter(F.col("OrderDate") >= F.lit(days[0])).count() == before
    inc.load_orders_window(spark, table, o, l, days[1])
    got = spark.table(table)
    assert got.filter(F.col("OrderDate") < F.lit(days[1])).count() == 0
    assert got.groupBy("OrderID").count().filter("count > 1").count() == 0
    # running the same window again changes nothing
    n = got.count()
    inc.load_orders_window(spark, table, o, l, days[1])
    assert spark.table(table).count() == n


def test_watermark_load_is_incremental(spark):
    root = new_run_dir(spark, "t_wm")
    control, sink = f"{root}/control", f"{root}/sink"
    spark.createDataFrame([("t", dt.datetime(2000, 1, 1))], inc.WATERMARK_DDL).write.parquet(control)
    src = spark.createDataFrame(
        [(1, dt.datetime(1999, 12, 31)), (2, dt.datetime(2000, 1, 1)), (3, dt.datetime(2000, 1, 2)),
         (4, dt.datetime(2000, 1, 3)), (5, None)], "id INT, wm TIMESTAMP_NTZ")
    assert inc.incremental_load(spark, src, "t", "wm", control, sink) == 1
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [3, 4]
    assert inc.incremental_load(spark, src, "t", "wm", control, sink) == 0
    assert spark.read.parquet(sink).count() == 2
    assert inc.read_marks(spark, control) == {"t": dt.datetime(2000, 1, 3)}


def test_medallion_partitions_input(spark):
    run = med.MedallionRun(spark, SF_SMALL).ingest()
    parsed = run.parsed_new().count()
    run.to_silver()
    clean = spark.table(run.silver).count()
    bad = spark.table(run.quarantine).count()
    assert clean + bad == parsed
    statuses = dict(spark.table(run.bronze).groupBy("Status").count().collect())
    assert set(statuses) <= {"Loaded", "Quarantined"}
    run.repair()
    left = spark.table(run.bronze).filter(F.col("Status") == "Quarantined")
    still = med.parse_bronze(left)
    # what stays quarantined cannot be repaired by abs(): a key field is missing
    assert still.filter(F.col("ReleaseDate").isNotNull() & F.col("RunTime").isNotNull()).count() == 0
    assert spark.table(run.silver).filter(F.col("RunTime") < 0).count() == 0


def test_stream_processes_only_new_files(spark):
    root = new_run_dir(spark, "t_stream")
    src = f"{root}/landing"
    db = new_database(spark, "t_stream")
    sink = f"{db}.sink"
    ddl = "id BIGINT"
    spark.range(0, 10).write.parquet(f"{src}/a")
    stream_new_records(spark, f"{src}/*", ddl, sink, f"{root}/ckpt")
    assert spark.table(sink).count() == 10
    stream_new_records(spark, f"{src}/*", ddl, sink, f"{root}/ckpt")
    assert spark.table(sink).count() == 10
    spark.range(10, 15).write.parquet(f"{src}/b")
    stream_new_records(spark, f"{src}/*", ddl, sink, f"{root}/ckpt")
    assert sorted(r.id for r in spark.table(sink).collect()) == list(range(15))


def test_status_merge_keeps_other_partitions(spark):
    run = med.MedallionRun(spark, SF_SMALL).ingest()
    raw_rows = spark.table(run.bronze).count()
    later = dt.datetime(2024, 2, 1, 9, 0, 0)
    med.raw_to_bronze(spark, run.raw_path, run.bronze, later)
    # a third partition that no merge touches
    stale = spark.table(run.bronze).limit(5).withColumn("p_Ingestdate", F.lit(dt.date(2023, 1, 1))) \
                 .withColumn("Status", F.lit("Loaded")).withColumn("record_key", F.lit("none"))
    stale.select(*spark.table(run.bronze).columns).write.insertInto(run.bronze)
    run.to_silver()
    b = spark.table(run.bronze)
    assert b.count() == 2 * raw_rows + 5
    assert b.filter(F.col("p_Ingestdate") == F.lit(dt.date(2023, 1, 1))).count() == 5
    assert b.filter(F.col("Status") == "New").count() == 0


def test_replayed_batch_is_stored_once(spark):
    from layerkit.streaming.file_stream import BATCH_COL, write_batch_idempotent
    db = new_database(spark, "t_replay")
    sink = f"{db}.sink"
    b0 = spark.range(0, 5)
    write_batch_idempotent(b0, 0, sink)
    write_batch_idempotent(spark.range(5, 8), 1, sink)
    write_batch_idempotent(spark.range(5, 8), 1, sink)  # replay after a failure
    got = spark.table(sink)
    assert sorted(r.id for r in got.collect()) == list(range(8))
    assert sorted(r[0] for r in got.select(BATCH_COL).distinct().collect()) == [0, 1]


def test_stream_archives_consumed_files(spark):
    import glob
    import os
    root = new_run_dir(spark, "t_archive")
    src, arch = f"{root}/landing", f"{root}/archive"
    db = new_database(spark, "t_archive")
    spark.range(0, 6).coalesce(1).write.parquet(src)
    stream_new_records(spark, src, "id BIGINT", f"{db}.sink", f"{root}/ckpt", archive_dir=arch)
    spark.range(6, 9).coalesce(1).write.mode("append").parquet(src)
    stream_new_records(spark, src, "id BIGINT", f"{db}.sink", f"{root}/ckpt", archive_dir=arch)
    assert spark.table(f"{db}.sink").count() == 9
    local = lambda p: p.replace("file:", "")
    archived = [f for f in glob.glob(f"{local(arch)}/**/*.parquet", recursive=True)]
    assert len(archived) >= 1
    assert all(not os.path.exists(local(src) + "/" + os.path.basename(f)) for f in archived)


def test_multi_day_load_is_all_or_nothing(spark):
    db = new_database(spark, "t_days")
    table = inc.create_ods_orders(spark, db)
    o, l = load(spark, SF_SMALL, "orders"), load(spark, SF_SMALL, "lineitem")
    days = [r[0].date() for r in o.select("o_orderdate").distinct().orderBy("o_orderdate").limit(3).collect()]
    inc.load_orders_for_dates(spark, table, o, l, days[:2])
    n = spark.table(table).count()
    with pytest.raises(inc.DateAlreadyLoaded):
        inc.load_orders_for_dates(spark, table, o, l, days[1:])
    assert spark.table(table).count() == n
    inc.load_orders_for_dates(spark, table, o, l, days[2:])
    assert spark.table(table).select("OrderDate").distinct().count() == 3


def test_second_medallion_run_adds_only_new_records(spark):
    recs = med.movie_records(spark, SF_SMALL)
    first = med.MedallionRun(spark, SF_SMALL).ingest(recs.filter(F.col("Id") < 100)).to_silver()
    n1 = spark.table(first.silver).count() + spark.table(first.quarantine).count()
    later = dt.datetime(2024, 2, 1, 9, 0, 0)
    second = med.MedallionRun(spark, SF_SMALL, run_ts=later, db=first.db,
                              raw_path=new_run_dir(spark, "t_raw2"))
    second.ingest(recs.filter(F.col("Id") >= 100)).to_silver()
    total = spark.table(first.silver).count() + spark.table(first.quarantine).count()
    assert total == recs.select("Id").distinct().count() and total > n1
    assert spark.table(first.bronze).filter(F.col("Status") == "New").count() == 0
    genres = spark.table(f"{first.db}.genres")
    assert genres.count() == genres.select("Genre_Id").distinct().count()
    pairs = spark.table(f"{first.db}.movie_genres")
    assert pairs.count() == pairs.distinct().count()


def test_watermark_load_repeats_after_a_lost_mark(spark, monkeypatch):
    root = new_run_dir(spark, "t_wm_crash")
    control, sink = f"{root}/control", f"{root}/sink"
    spark.createDataFrame([("t", dt.datetime(2000, 1, 1))], inc.WATERMARK_DDL).write.parquet(control)
    src = spark.createDataFrame([(d, dt.datetime(2000, 1, d)) for d in range(1, 6)], "id INT, wm TIMESTAMP_NTZ")

    def lost(*_):
        raise OSError("lost before the mark")
    with monkeypatch.context() as m:
        m.setattr(inc, "set_marks", lost)
        with pytest.raises(OSError):
            inc.incremental_load(spark, src.filter("id < 4"), "t", "wm", control, sink)
    assert inc.incremental_load(spark, src, "t", "wm", control, sink) == 1  # more rows have come meanwhile
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [2, 3, 4, 5]


def test_refused_window_deletes_nothing(spark):
    table = inc.create_ods_orders(spark, new_database(spark, "t_ods"))
    o, l = load(spark, SF_SMALL, "orders"), load(spark, SF_SMALL, "lineitem")
    days = [r[0].date() for r in o.select("o_orderdate").distinct().orderBy("o_orderdate").limit(3).collect()]
    inc.load_orders_for_dates(spark, table, o, l, days)
    n = spark.table(table).count()
    with pytest.raises(inc.KeyConflict):
        inc.load_orders_window(spark, table, o, l, days[1], include_start=True, on_conflict="error")
    assert spark.table(table).count() == n


def test_medallion_repeats_after_a_lost_status_and_a_second_delivery(spark, monkeypatch):
    run = med.MedallionRun(spark, SF_SMALL).ingest()

    def lost(*_, **__):
        raise OSError("lost before the status")

    def content():
        return [sorted(r[0] for r in spark.table(t).select("record_key").collect()) for t in (run.silver, run.quarantine)]
    for step in (run.to_silver, run.repair):
        with monkeypatch.context() as m:
            m.setattr(med, "update_status", lost)
            with pytest.raises(OSError):
                step()
        once = content()
        step()
        assert content() == once
    silver, held = content()
    assert len(set(silver)) == len(silver) and not set(silver) & set(held)
    med.raw_to_bronze(spark, run.raw_path, run.bronze, dt.datetime(2024, 2, 1, 9, 0, 0))
    run.to_silver()
    run.repair()
    assert content() == [silver, held]
    assert spark.table(run.bronze).filter(F.col("Status") == "New").count() == 0
