from pyspark.sql import functions as F

from layerkit.functions import (array_or_scalar, avg_int, capitalize_first, clean_people,
                                json_value, nested_json, strip_all)


def test_json_value_scalars_only(spark):
    df = spark.createDataFrame([
        ('{"a": {"b": 1}, "s": "txt", "n": 7, "arr": [1, 2], "E": [{"C": "x"}, {"C": "y"}], "b": "{x}"}',),
        ('not json',), (None,)], "j STRING")
    got = df.select(json_value("j", "$.a").alias("obj"), json_value("j", "$.arr").alias("arr"),
                    json_value("j", "$.s").alias("s"), json_value("j", "$.n").alias("n"),
                    json_value("j", "$.E[1].C").alias("idx"), json_value("j", "$.zz").alias("miss"),
                    json_value("j", "$.b").alias("brace")).collect()
    assert tuple(got[0]) == (None, None, "txt", "7", "y", None, "{x}")
    assert tuple(got[1]) == (None,) * 7 and tuple(got[2]) == (None,) * 7


def test_array_or_scalar(spark):
    df = spark.createDataFrame([('{"o": [6, 7]}',), ('{"o": "7"}',), ('{"o": null}',), ('{}',)], "j STRING")
    got = [r[0] for r in df.select(array_or_scalar("j", "$.o", "int")).collect()]
    assert got == [[6, 7], [7], None, None]
    assert df.select(F.explode(array_or_scalar("j", "$.o", "int"))).count() == 3


def test_nested_json_and_xml(spark):
    df = spark.createDataFrame([(2013, 5, None)], "y INT, a BIGINT, b BIGINT")
    j = df.select(F.to_json(nested_json({"Year": "y", "G.A": "a", "G.B": "b"}))).first()[0]
    assert j == '{"Year":2013,"G":{"A":5}}'
    x = df.select(F.to_xml(F.struct(F.col("y").alias("_Year"), F.col("a").alias("A"), F.col("b").alias("B")),
                           {"rowTag": "StockItems"})).first()[0]
    assert x == '<StockItems Year="2013">\n    <A>5</A>\n</StockItems>'


def test_text_cleaning(spark):
    df = spark.createDataFrame([
        ("  mcDONALD\t", "mary ann ", "555-12-34", "No.5 #3 Rd"),
        ("McDonald", "\tMary ann", "5551234", "5 3 Rd"),
        ("x", "y", None, "\nNo.1 Rd ")], "FirstName STRING, LastName STRING, Phone STRING, Address STRING")
    out = sorted(tuple(r) for r in clean_people(df).collect())
    assert out == [("Mcdonald", "Mary ann", "5551234", "5 3 Rd"), ("X", "Y", None, "1 Rd")]
    assert df.select(strip_all(F.lit(" \t a b \n"))).first()[0] == "a b"
    assert df.select(capitalize_first(F.lit("mary ANN"))).first()[0] == "Mary ann"


def test_avg_int_truncates_toward_zero(spark):
    df = spark.createDataFrame([(-3,), (-4,), (1,), (5,), (6,)], "d INT").withColumn("g", F.col("d") > 0)
    got = dict(df.groupBy("g").agg(avg_int("d")).collect())
    assert got == {False: -3, True: 4}
