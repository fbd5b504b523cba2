import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerkit.operators import distinct_by_key, map_columns, mark_rows, repair_by_lookup
from layerkit.operators.merge import (apply_merge, create_partitioned_table, drop_partitions_where,
                                      merge_update, truncate_table)
from layerkit.plans import retail
from layerkit.plans.pipelines import epoch_to_time
from layerkit.schemas import assert_schema, conform, parse_ddl
from layerkit.session import new_database, new_run_dir
from layerkit.sources.files import layer_path, read_json_array
from layerkit.sources.tables import load
from layerkit.sources.writers import batch_writer, register_table
from tests.conftest import SF_SMALL


def test_map_columns_rename_qualified_and_duplicates(spark):
    c = spark.createDataFrame([(1, "x", 10)], "CustomerID INT, CustomerName STRING, ValidFrom INT")
    p = spark.createDataFrame([(10, 99)], "PersonID INT, ValidFrom INT")
    j = c.alias("cust").join(p.alias("ppl"), F.col("cust.ValidFrom") == F.col("ppl.PersonID"))
    out = map_columns(j, [("SourceCustomerID", "CustomerID"), ("Primary Contact", F.lit("p")),
                          ("ValidFrom", "cust.ValidFrom"), ("ValidFrom", "ppl.ValidFrom")])
    assert out.columns == ["SourceCustomerID", "Primary Contact", "ValidFrom"]
    assert tuple(out.first()) == (1, "p", 10)
    with pytest.raises(ValueError):
        map_columns(j, [("a", "CustomerID"), ("A", "CustomerName")], on_duplicate="error")


def test_mark_rows(spark):
    df = spark.createDataFrame([("Quarantined",), ("New",), (None,)], "Status STRING")
    got = [r._action for r in mark_rows(df, F.col("Status") == "Quarantined").collect()]
    assert got == ["update", "insert", "insert"]


def test_repair_by_lookup(spark):
    bad = spark.createDataFrame([(1, "dev-a", 5), (2, "dev-z", 6)], "value INT, device_id STRING, steps INT")
    users = spark.createDataFrame([("dev-a", 77)], "user_id STRING, device_num BIGINT")
    out = repair_by_lookup(bad, users, "device_id", "user_id", "device_num", "int", "device_id")
    assert [tuple(r) for r in out.collect()] == [(1, 5, 77)]


def test_distinct_by_key(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "Genre_Id INT, Genre_Name STRING")
    assert sorted(tuple(r) for r in distinct_by_key(df, "Genre_Id").collect()) == [(1, "a"), (2, "c")]
    assert distinct_by_key(df, "Genre_Id", deterministic=False).count() == 2


def test_epoch_to_time(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.createDataFrame([(0,), (1577934000,)], "time BIGINT")
    assert [r.time for r in epoch_to_time(df, "time").collect()] == ["1970-01-01 00:00:00", "2020-01-02 03:00:00"]


def test_conform_and_assert_schema(spark):
    df = spark.createDataFrame([("1", "2.5", "x")], "a STRING, b STRING, extra STRING")
    out = conform(df, "a INT, b DECIMAL(18,2), c DATE")
    assert [f.name for f in out.schema] == ["a", "b", "c"]
    assert tuple(out.first()) == (1, __import__("decimal").Decimal("2.50"), None)
    assert_schema(out, parse_ddl(spark, "a INT, b DECIMAL(18,2), c DATE"))
    with pytest.raises(AssertionError):
        assert_schema(out, parse_ddl(spark, "a BIGINT, b DECIMAL(18,2), c DATE"))
    with pytest.raises(ValueError):
        conform(df, "zz INT", allow_missing=False)


def test_truncate_register_and_partition_merge(spark):
    db = new_database(spark, "t_tables")
    t = f"{db}.t"
    create_partitioned_table(spark, t, "k INT, v STRING, d DATE", "d")
    spark.createDataFrame([(1, "a", dt.date(2020, 1, 1)), (2, "b", dt.date(2020, 1, 2)),
                           (3, "c", dt.date(2020, 1, 2))], "k INT, v STRING, d DATE").write.insertInto(t)
    # update one key: only the 2020-01-02 partition is rewritten
    part = spark.table(t).filter(F.col("d") == F.lit(dt.date(2020, 1, 2)))
    src = spark.createDataFrame([(2, "B")], "k INT, v STRING")
    apply_merge(spark, t, "d", merge_update(part, src, "k", {"v": "v"}))
    assert sorted(tuple(r) for r in spark.table(t).select("k", "v").collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert drop_partitions_where(spark, t, "d", F.col("d") < F.lit("2020-01-02")) == 1
    assert spark.table(t).count() == 2
    truncate_table(spark, t)
    assert spark.table(t).count() == 0
    # re-register a table over an existing partitioned folder
    path = layer_path(new_run_dir(spark, "t_reg"), "bronze", "movies")
    batch_writer(spark.createDataFrame([(1, "x"), (2, "y")], "id INT, p STRING"), "p").save(path)
    register_table(spark, f"{db}.reg", path, partitioned=True)
    register_table(spark, f"{db}.reg", path, partitioned=True)
    assert spark.table(f"{db}.reg").count() == 2


def test_multiline_json_documents(spark):
    path = new_run_dir(spark, "t_json")
    spark.createDataFrame([('{\n "movie": [\n  {"Id": 1},\n  {"Id": 2, "x": [1, 2]}\n ]\n}',)], "value STRING") \
        .coalesce(1).write.text(path)
    got = [r.Movies for r in read_json_array(spark, path).collect()]
    assert [__import__("json").loads(g)["Id"] for g in got] == [1, 2]
    assert read_json_array(spark, path, row_limit=1).count() == 1


def test_documents_are_read_once_whatever_they_hold(spark):
    path, few = new_run_dir(spark, "t_json"), '{"movie": [{"Id" : 1,\n "x": 1e5}, {"Id": 2, "x": "é\\u00e9"}, null]}\n'
    many = '{"movie": [' + ",".join('{"Id": %d, "t": "%s"}' % (i, "t" * 40) for i in range(3000)) + "]}"
    spark.createDataFrame([(few,)], "value STRING").coalesce(1).write.text(f"{path}/few")
    spark.createDataFrame([(many,)], "value STRING").coalesce(1).write.text(f"{path}/many")
    got = [r.Movies for r in read_json_array(spark, f"{path}/few").collect()]
    assert got == ['{"Id" : 1,\n "x": 1e5}', '{"Id": 2, "x": "é\\u00e9"}', None]

    def bytes_read():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = bytes_read()
    assert read_json_array(spark, f"{path}/many").agg(F.count("Movies"), F.max("Movies")).first()[0] == 3000
    assert bytes_read() - before < 5 * len(many)
    # a document that is larger than a split is still one document
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        ids = read_json_array(spark, f"{path}/many").select(F.get_json_object("Movies", "$.Id").cast("int").alias("i")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.i for r in ids) == list(range(3000))


def test_sql_table_function_matches_apply(spark):
    load(spark, SF_SMALL, "lineitem").createOrReplaceTempView("lineitem")
    load(spark, SF_SMALL, "orders").createOrReplaceTempView("orders")
    retail.register_order_total_function(spark)
    via_sql = spark.sql("""SELECT o.o_orderkey, CAST(f.total AS DOUBLE) AS total
                           FROM orders o, LATERAL order_total(o.o_orderkey) f""")
    via_df = retail.q20_tvf_apply(spark, SF_SMALL).select("o_orderkey", "total")
    assert sorted(via_sql.collect()) == sorted(via_df.collect())


def test_bucketed_upsert(spark):
    from layerkit.operators.merge import upsert_into_table
    db = new_database(spark, "t_upsert")
    t = f"{db}.ods"
    upsert_into_table(spark, t, spark.createDataFrame([(i, "v1") for i in range(20)], "k INT, v STRING"), "k",
                      buckets=4)
    upsert_into_table(spark, t, spark.createDataFrame([(i, "v2") for i in range(15, 25)], "k INT, v STRING"), "k",
                      buckets=4)
    got = dict((r.k, r.v) for r in spark.table(t).collect())
    assert len(got) == 25 and spark.table(t).count() == 25
    assert all(got[i] == ("v2" if i >= 15 else "v1") for i in range(25))


def test_views_and_current_time_stamp(spark):
    from layerkit.plans.medallion import stamp_ingest
    names = retail.register_views(spark, SF_SMALL)
    assert sorted(spark.table(names[0]).collect()) == sorted(retail.q18_pivot_years(spark, SF_SMALL).collect())
    raw = spark.createDataFrame([('{"Id": 1}',)], "Movies STRING")
    row = stamp_ingest(raw, None).first()
    assert row.Status == "New" and row.Ingesttime is not None and row.p_Ingestdate == row.Ingesttime.date()


def test_spark_sql_over_registered_views(spark):
    from layerkit.plans import oracles
    from layerkit.sources import register_views
    register_views(spark, SF_SMALL)
    for name in ("q01_or_join", "q02_join_residual", "q05_len_filter", "q11_between", "q03_lapsed_customers"):
        via_sql = sorted(map(tuple, spark.sql(oracles.RETAIL[name]).collect()), key=repr)
        via_df = sorted(map(tuple, getattr(retail, name)(spark, SF_SMALL).collect()), key=repr)
        assert via_sql == via_df, name


def test_concurrent_upserts_keep_every_partition(spark):
    from concurrent.futures import ThreadPoolExecutor

    from layerkit.operators.merge import upsert_into_table
    db = new_database(spark, "t_conc")
    tables = [f"{db}.a", f"{db}.b"]

    def batch(lo, hi):
        return spark.createDataFrame([(i, f"v{lo}") for i in range(lo, hi)], "k INT, v STRING")

    for lo, hi in ((0, 40), (30, 60)):
        with ThreadPoolExecutor(max_workers=2) as pool:
            for f in [pool.submit(upsert_into_table, spark, t, batch(lo, hi), "k", 4) for t in tables]:
                f.result()
    for t in tables:
        got = dict((r.k, r.v) for r in spark.table(t).collect())
        assert spark.table(t).count() == 60 and len(got) == 60
        assert all(got[i] == ("v30" if i >= 30 else "v0") for i in range(60))
