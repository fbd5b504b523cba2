"""Property checks against brute-force Python models (small example budgets:
every example runs Spark jobs)."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerkit.functions.dates import ts_lit
from layerkit.operators import anti_join_not_in, merge_upsert, or_join, split_rows
from layerkit.plans import incremental as inc
from layerkit.session import new_run_dir

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
small_int = st.one_of(st.none(), st.integers(min_value=0, max_value=4))


@SETTINGS
@given(left=st.lists(small_int, max_size=12), right=st.lists(small_int, max_size=6))
def test_not_in_model(spark, left, right):
    l = spark.createDataFrame([(v,) for v in left], "k INT")
    r = spark.createDataFrame([(v,) for v in right], "k INT")
    got = sorted(r[0] for r in anti_join_not_in(l, r, "k").collect())
    exp = [] if None in right else sorted(v for v in left if v is not None and v not in right)
    assert got == exp


@SETTINGS
@given(left=st.lists(st.tuples(small_int, small_int), max_size=8),
       right=st.lists(st.tuples(small_int, small_int), max_size=5))
def test_or_join_model(spark, left, right):
    l = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(left)], "li INT, la INT, lb INT")
    r = spark.createDataFrame([(j, a, b) for j, (a, b) in enumerate(right)], "ri INT, ra INT, rb INT")
    got = sorted((x.li, -1 if x.ri is None else x.ri)
                 for x in or_join(l, r, [("la", "ra"), ("lb", "rb")], "left").collect())
    exp = []
    for i, (la, lb) in enumerate(left):
        hits = [j for j, (ra, rb) in enumerate(right)
                if (la is not None and la == ra) or (lb is not None and lb == rb)]
        exp += [(i, j) for j in hits] or [(i, -1)]
    assert got == sorted(exp)


@SETTINGS
@given(vals=st.lists(small_int, max_size=12))
def test_split_is_a_partition(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i INT, v INT")
    ok, rest = split_rows(df, F.col("v") >= 2)
    a = {r.i for r in ok.collect()}
    b = {r.i for r in rest.collect()}
    assert a | b == set(range(len(vals))) and not a & b
    assert a == {i for i, v in enumerate(vals) if v is not None and v >= 2}


@SETTINGS
@given(target=st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=8),
       src=st.dictionaries(st.integers(0, 9), st.integers(100, 199), max_size=8))
def test_upsert_model(spark, target, src):
    t = spark.createDataFrame(list(target.items()) or [], "k INT, v INT")
    s = spark.createDataFrame(list(src.items()) or [], "k INT, v INT")
    got = dict((r.k, r.v) for r in merge_upsert(t, s, "k").collect())
    assert got == {**target, **src}


def test_incremental_runs_equal_one_full_run(spark):
    rows = [(i, dt.datetime(2000, 1, 1) + dt.timedelta(hours=7 * i)) for i in range(40)] + [(99, None)]
    src = spark.createDataFrame(rows, "id INT, wm TIMESTAMP_NTZ")
    start = dt.datetime(1999, 12, 31)

    def run(splits):
        root = new_run_dir(spark, "t_incr")
        control, sink = f"{root}/control", f"{root}/sink"
        spark.createDataFrame([("t", start)], inc.WATERMARK_DDL).write.parquet(control)
        for upto in splits:
            inc.incremental_load(spark, src.filter(F.col("wm") <= ts_lit(upto)),
                                 "t", "wm", control, sink)
        return sorted(r.id for r in spark.read.parquet(sink).collect())

    end = dt.datetime(2000, 3, 1)
    assert run([dt.datetime(2000, 1, 5), dt.datetime(2000, 1, 9), end]) == run([end]) == list(range(40))
