"""Ordered output, whole documents, drifting schemas, positional unions, persistent keys."""
import json
import xml.etree.ElementTree as ElementTree

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.operators.joins import match_join
from layerkit.operators.keys import register_members
from layerkit.operators.projection import union_by_position
from layerkit.schemas import merged_schema, parse_ddl, wider_type
from layerkit.session import new_database, new_run_dir
from layerkit.sources import folders
from layerkit.sources.ordered import read_json_array_parts, read_ordered, read_parts, write_json_array, write_ordered, write_xml_document
from layerkit.sources.writers import read_runs, write_run


def parts_text(spark, path):
    """The part files one after the other, in name order."""
    return "".join("".join(r[0] for r in spark.read.text(f, wholetext=True).collect()) for f in folders.data_files(spark, path))


def test_ordered_rows_come_back_in_order(spark):
    path = f"{new_run_dir(spark, 't_ord')}/rows"
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("k"), F.when(F.col("id") % 50 == 3, F.lit(None)).otherwise(F.col("id") % 7).alias("g"))
    write_ordered(df, [F.col("g").desc(), "k"], path)
    got = [(r["row_no"], r["g"], r["k"]) for r in read_ordered(spark, path).orderBy("row_no").collect()]
    want = sorted(((r["g"], r["k"]) for r in df.collect()), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert [g[1:] for g in got] == want and [g[0] for g in got] == list(range(1, 501))
    assert len(folders.data_files(spark, path)) > 1


@pytest.mark.parametrize("n", [0, 1, 300])
def test_json_and_xml_documents_are_whole_and_valid(spark, n):
    path = new_run_dir(spark, "t_doc")
    df = spark.range(n).select("id", F.concat(F.lit('}] "<&> '), F.col("id").cast("string"), F.lit(" ]")).alias("text"),
                               F.when(F.col("id") % 2 == 0, F.lit(1)).alias("even"))
    write_json_array(df, [F.col("id").desc()], f"{path}/json", F.struct("id", "text", F.struct("even").alias("in")))
    document = json.loads(parts_text(spark, f"{path}/json"))
    assert [d["id"] for d in document] == list(range(n - 1, -1, -1))
    assert all(d["text"] == f'}}] "<&> {d["id"]} ]' for d in document)
    back = read_json_array_parts(spark, f"{path}/json", "id LONG, text STRING").orderBy("row_no").collect()
    assert [(r["row_no"], r["item"]["id"], r["item"]["text"]) for r in back] == [(i + 1, d["id"], d["text"]) for i, d in enumerate(document)]
    write_xml_document(df, ["id"], f"{path}/xml", F.struct(F.col("id").alias("_id"), "text"), "row", "rows")
    root = ElementTree.fromstring(parts_text(spark, f"{path}/xml").replace("\n", ""))
    assert root.tag == "rows" and [e.get("id") for e in root] == [str(i) for i in range(n)]
    if n > 1:
        assert len(folders.data_files(spark, f"{path}/json")) > 1
        assert read_parts(spark, f"{path}/xml").count() == n


def test_wider_types():
    d = T.DecimalType
    for a, b, want in [(T.IntegerType(), T.LongType(), T.LongType()), (T.LongType(), T.DoubleType(), T.DoubleType()),
                       (d(10, 2), d(12, 4), d(12, 4)), (d(10, 2), T.IntegerType(), d(12, 2)), (d(38, 0), d(38, 30), T.DoubleType()),
                       (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.IntegerType(), T.StringType(), T.StringType()),
                       (T.BooleanType(), T.IntegerType(), T.StringType()), (T.NullType(), T.DateType(), T.DateType()),
                       (T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), T.ArrayType(T.LongType()))]:
        assert wider_type(a, b) == want and wider_type(b, a) == want


def test_merged_schema_by_name(spark):
    old, new = parse_ddl(spark, "A INT, s STRUCT<x: INT>, gone STRING"), parse_ddl(spark, "s STRUCT<y: STRING, X: BIGINT>, a BIGINT, fresh DATE")
    assert merged_schema(old, new).simpleString() == "struct<A:bigint,s:struct<x:bigint,y:string>,gone:string,fresh:date>"


def test_runs_that_agree_are_one_scan_and_a_repeated_run_replaces(spark):
    path = f"{new_run_dir(spark, 't_drift')}/sink"
    for run in range(4):
        write_run(spark.range(10).selectExpr("CAST(id AS INT) id", f"{run} run_no"), path, str(run))
    write_run(spark.range(3).selectExpr("id", "'x' note"), path, "9")
    write_run(spark.range(2).selectExpr("id", "'y' note"), path, "9")
    df = read_runs(spark, path)
    assert df.dtypes == [("id", "bigint"), ("run_no", "int"), ("note", "string")]
    assert df.count() == 42 and df.where("note = 'y'").count() == 2 and df.where("note = 'x'").count() == 0
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    with pytest.raises(FileNotFoundError):
        read_runs(spark, path + "-none")


def test_union_by_position(spark):
    a = spark.createDataFrame([(1, "x", 2.5)], "k INT, t STRING, v DOUBLE")
    b = spark.createDataFrame([("7", "y", 3), (None, None, None)], "other STRING, k STRING, v INT")
    out = union_by_position(a, b)
    assert out.dtypes == [("k", "int"), ("t", "string"), ("v", "double")]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [(1, "x", 2.5), (7, "y", 3.0), (None, None, None)]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        union_by_position(a, spark.createDataFrame([("seven", "y", 3)], "o STRING, k STRING, v INT")).collect()
    with pytest.raises(ValueError):
        union_by_position(a, a.select("k"))


def test_members_keep_their_keys(spark):
    table = f"{new_database(spark, 't_keys')}.genres"

    def members(*rows):
        return spark.createDataFrame(list(rows), "name STRING, source INT")

    first = {(r["name"], r["source"]): r["k"] for r in register_members(spark, table, members(("b", 1), ("a", 1), ("b", 1), (None, 2)), "k").collect()}
    assert sorted(first.values()) == [1, 2, 3] and first[("a", 1)] < first[("b", 1)]
    files = set(spark.table(table).inputFiles())
    second = {(r["name"], r["source"]): r["k"] for r in register_members(spark, table, members((None, 2), ("a", 2), ("0", 0), ("a", 1)), "k").collect()}
    assert {m: second[m] for m in first} == first and sorted(second.values()) == [1, 2, 3, 4, 5] and second[("0", 0)] == 4
    assert files <= set(spark.table(table).inputFiles())
    assert register_members(spark, table, members(("a", 1)), "k").count() == 5


def test_match_join_ignores_blanks_only_when_asked(spark):
    a = spark.createDataFrame([("a b", 1), (" ab", 2), ("c", 3)], "x STRING, n INT")
    b = spark.createDataFrame([("ab", 10), ("c", 20)], "y STRING, m INT")
    assert sorted(tuple(r) for r in match_join(a, b, [("x", "y")]).collect()) == [("c", 3, "c", 20)]
    loose = match_join(a, b, [("x", "y")], ignore_spaces=True)
    assert sorted(tuple(r) for r in loose.collect()) == [(" ab", 2, "ab", 10), ("a b", 1, "ab", 10), ("c", 3, "c", 20)]
    assert "NestedLoop" not in loose._jdf.queryExecution().executedPlan().toString()
