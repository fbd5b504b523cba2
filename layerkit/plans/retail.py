"""Retail query set on the driver tables.

Stand-ins: orders -> Orders, lineitem -> OrderLines, customer -> Customers,
supplier -> People, part -> StockItems (p_type = stock group), nation -> Cities,
region -> StateProvinces, events -> JSON custom fields, lineitem -> delivery
event documents. Money is summed as exact DECIMAL(18,2) and handed out as DOUBLE;
quantities are integral and summed as BIGINT.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import avg_int, days_between, ts_lit, year_range
from ..functions.json import json_value, nested_json
from ..operators.aggregates import pivot_sum, top_per_group
from ..operators.joins import anti_join_not_in, or_join, skew_join
from ..sources.tables import load

# Query parameters of the exercises, restated for the driver tables.
LAPSED_CUTOFF = dt.datetime(2001, 6, 1)
COUNT_YEAR = 1997
EXCLUDED_NATIONS = ("NATION_1", "NATION_2")
NOT_IN_YEAR = 1998
STOCK_YEAR = 1999
LIKE_YEAR = 1996
LIKE_PATTERN = "%ring%"
LIKE_MAX_UNITS = 100
BETWEEN_FROM = dt.datetime(2001, 1, 1)
BETWEEN_AS_OF = dt.datetime(2001, 7, 15)
DETAIL_DATE = dt.datetime(1995, 7, 12)
TOP_YEAR = 1996
PIVOT_YEARS = [1996, 1997, 1998, 1999, 2000]
PIVOT_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
JSON_K_VALUE = "9"
JSON_EVENT_TYPE = "purchase"


def money(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(18,2)")


def qty(c="l_quantity") -> F.Column:
    return F.col(c).cast("long")


def _t(spark, sf, name):
    return load(spark, sf, name)


# Q1: OR join, left outer ------------------------------------------------------
def q01_or_join(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return or_join(c, s, [("c_custkey", "s_suppkey"), ("c_nationkey", "s_nationkey")],
                   how="left", heavy=True).select("c_custkey", "c_name", "s_suppkey", "s_name")


# Q2: inner join plus a column-to-column predicate -----------------------------
def q02_join_residual(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", F.substring("c_name", -2, 2).alias("c_end"))
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_nationkey", F.substring("s_name", -2, 2).alias("s_end"))
    return (skew_join(c, s, [("c_nationkey", "s_nationkey"), ("c_end", "s_end")])
            .select("c_custkey", "c_name", "s_suppkey"))


# Q3: NOT IN subquery ------------------------------------------------------------
def q03_lapsed_customers(spark, sf):
    o = _t(spark, sf, "orders")
    old = o.filter(F.col("o_orderdate") < ts_lit(LAPSED_CUTOFF)).select("o_custkey")
    recent = o.filter(F.col("o_orderdate") >= ts_lit(LAPSED_CUTOFF)).select("o_custkey")
    return anti_join_not_in(old, recent, "o_custkey")


# Q4: left join chain, COUNT(column) ---------------------------------------------
def q04_count_by_name(spark, sf):
    o = _t(spark, sf, "orders").filter(year_range("o_orderdate", COUNT_YEAR))
    l = _t(spark, sf, "lineitem")
    p = _t(spark, sf, "part")
    j = (o.join(l, l.l_orderkey == o.o_orderkey, "left")
          .join(p, l.l_partkey == p.p_partkey, "left"))
    return j.groupBy("p_name").agg(F.count("p_name").alias("quantity"))


def part_history(spark, sf) -> DataFrame:
    """System-versioned history of stock items: 1-3 versions per item, each valid
    for 1,000 days from 1990-01-01 on (the last one open-ended)."""
    p = _t(spark, sf, "part").select("p_partkey", "p_name")
    versions = (F.col("p_partkey") % 3 + 1).cast("int")
    h = p.withColumn("n_versions", versions).withColumn("version", F.explode(F.sequence(F.lit(1), versions)))
    start = F.date_add(ts_lit(dt.date(1990, 1, 1)), (F.col("version") - 1) * 1000)
    end = F.when(F.col("version") < F.col("n_versions"), F.date_add(start, 1000))
    return h.select("p_partkey", "p_name", "version", start.alias("ValidFrom"), end.alias("ValidTo"))


def q04_archive_count(spark, sf):
    """Q4 against the history table: every version of an item joins, so items
    with several versions count once per version (the expected fan-out)."""
    o = _t(spark, sf, "orders").filter(year_range("o_orderdate", COUNT_YEAR))
    l = _t(spark, sf, "lineitem")
    h = part_history(spark, sf)
    j = (o.join(l, l.l_orderkey == o.o_orderkey, "left")
          .join(h, l.l_partkey == h.p_partkey, "left"))
    return j.groupBy("p_name").agg(F.count("p_name").alias("quantity"))


# Q5: LEN(x) > 10 (trailing blanks ignored) ---------------------------------------
def q05_len_filter(spark, sf):
    p = _t(spark, sf, "part")
    return p.filter(F.length(F.rtrim("p_name")) > 10).select("p_partkey", "p_name")


# Q6: NOT IN literal list over a left-join chain, DISTINCT -------------------------
def q06_not_in_regions(spark, sf):
    p = _t(spark, sf, "part")
    l = _t(spark, sf, "lineitem")
    o = _t(spark, sf, "orders")
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    # the WHERE clause needs an order and a nation, so the left joins are inner ones:
    # the year's orders are reduced first and the lines shuffled once before the items
    kept = (o.filter(year_range("o_orderdate", NOT_IN_YEAR)).join(c, c.c_custkey == o.o_custkey)
             .join(n.filter(~F.col("n_name").isin(*EXCLUDED_NATIONS)), n.n_nationkey == c.c_nationkey).select("o_orderkey"))
    parts = l.join(kept, kept.o_orderkey == l.l_orderkey).select("l_partkey").distinct()
    return p.join(parts, parts.l_partkey == p.p_partkey).select("p_name").distinct()


def _processing(spark, sf):
    l = _t(spark, sf, "lineitem")
    o = _t(spark, sf, "orders")
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    # orders get their nation first, so the lines are shuffled once, by order
    placed = (o.join(c, c.c_custkey == o.o_custkey, "left").join(n, n.n_nationkey == c.c_nationkey, "left")
               .select("o_orderkey", "o_orderdate", "n_name"))
    return (l.join(placed, l.l_orderkey == placed.o_orderkey, "left")
             .withColumn("days", days_between("o_orderdate", "l_shipdate")))


# Q7 / Q8: integer AVG of day differences -------------------------------------------
def q07_avg_days(spark, sf):
    return _processing(spark, sf).groupBy("n_name").agg(avg_int("days").alias("avg_process_days"))


def q08_by_month(spark, sf):
    j = _processing(spark, sf).withColumn("month", F.month("o_orderdate"))
    return j.groupBy("n_name", "month").agg(avg_int("days").alias("avg_process_days"))


# Q9: two CTE aggregates joined and compared --------------------------------------------
def q09_bought_gt_sold(spark, sf):
    """Purchased ('R' lines x pack size) vs sold (all other lines) per item in one year.

    Both CTEs read the same lines of the same year, so they are computed in one
    pass with conditional sums; an item needs both sides for the comparison to
    hold, exactly as the left join followed by ``purchased > sold`` requires."""
    p = _t(spark, sf, "part")
    l = _t(spark, sf, "lineitem")
    o = _t(spark, sf, "orders").filter(year_range("o_orderdate", STOCK_YEAR))
    j = l.join(o, o.o_orderkey == l.l_orderkey).join(p, l.l_partkey == p.p_partkey)
    flag = F.col("l_returnflag")
    agg = j.groupBy("p_partkey", "p_name").agg(
        F.sum(F.when(flag == "R", qty() * F.col("p_size"))).alias("quantity_purchased"),
        F.sum(F.when(flag != "R", qty())).alias("quantity_sold"))
    return (agg.filter(F.col("quantity_purchased") > F.col("quantity_sold"))
               .select("p_partkey", "p_name", "quantity_purchased", "quantity_sold"))


# Q10: two-level aggregate with HAVING, case-insensitive LIKE -------------------------------
def q10_having_like(spark, sf):
    """Customers with at most LIKE_MAX_UNITS units of matching items in the year.

    The per-order sums of the original are summed again per customer; a sum of
    sums is one sum, so a single aggregation (one shuffle) gives the same HAVING."""
    o = _t(spark, sf, "orders").filter(year_range("o_orderdate", LIKE_YEAR))
    l = _t(spark, sf, "lineitem")
    p = _t(spark, sf, "part").filter(F.col("p_name").ilike(LIKE_PATTERN))
    cte = (o.join(l, o.o_orderkey == l.l_orderkey)
            .join(p, l.l_partkey == p.p_partkey)
            .groupBy("o_custkey").agg(F.sum(qty()).alias("total"))
            .filter(F.col("total") <= LIKE_MAX_UNITS))
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    return (cte.join(c, cte.o_custkey == c.c_custkey, "left")
               .join(n, n.n_nationkey == c.c_nationkey, "left")
               .select("c_custkey", "c_name", F.col("n_name").alias("primary_contact")))


# Q11: BETWEEN with an as-of upper bound -------------------------------------------------
def q11_between(spark, sf, as_of: dt.datetime = BETWEEN_AS_OF):
    o = _t(spark, sf, "orders")
    return (o.filter(F.col("o_orderdate").between(ts_lit(BETWEEN_FROM), ts_lit(as_of)))
             .select("o_orderkey", "o_orderdate"))


# Q12: wide left-join chain for one order date ----------------------------------------------
def q12_wide_join(spark, sf, day: dt.datetime = DETAIL_DATE):
    l = _t(spark, sf, "lineitem")
    o = _t(spark, sf, "orders")
    c = _t(spark, sf, "customer")
    p = _t(spark, sf, "part")
    n = _t(spark, sf, "nation")
    r = _t(spark, sf, "region")
    j = (l.join(o, l.l_orderkey == o.o_orderkey, "left")
          .join(c, c.c_custkey == o.o_custkey, "left")
          .join(p, p.p_partkey == l.l_partkey, "left")
          .join(n, n.n_nationkey == c.c_nationkey, "left")
          .join(r, r.r_regionkey == n.n_regionkey, "left"))
    return (j.filter(F.col("o_orderdate") == ts_lit(day))
             .select("l_orderkey", "l_linenumber", "p_name", "c_name", "c_mktsegment",
                     "n_name", "r_name", qty().alias("quantity")))


# Q13: purchased vs sold per group, difference ---------------------------------------------
def q13_group_balance(spark, sf):
    """Per group: purchased ('R' lines), ordered (all other lines) and what remains.

    One scan with conditional sums replaces the two CTE aggregates; groups
    without purchases are dropped as the purchased-side left join does."""
    l = _t(spark, sf, "lineitem")
    p = _t(spark, sf, "part")
    flag = F.col("l_returnflag")
    agg = (l.join(p, l.l_partkey == p.p_partkey, "left").groupBy("p_type").agg(
        F.sum(F.when(flag == "R", qty())).alias("quantity_purchased"),
        F.sum(F.when(flag != "R", qty())).alias("quantity_ordered"),
        F.count(F.when(flag == "R", 1)).alias("n_purchases")))
    return (agg.filter(F.col("n_purchases") > 0)
               .select("p_type", "quantity_purchased", "quantity_ordered",
                       (F.col("quantity_purchased") - F.col("quantity_ordered")).alias("quantity_remaining")))


# Q14: most delivered item per nation (ties kept), right join, 'No Sale' -------------------------
def q14_top_item_by_city(spark, sf, year: int = TOP_YEAR):
    l = _t(spark, sf, "lineitem")
    o = _t(spark, sf, "orders").filter(year_range("o_orderdate", year))
    c = _t(spark, sf, "customer")
    placed = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_nationkey")
    cte1 = (l.join(placed, placed.o_orderkey == l.l_orderkey)
             .groupBy("l_partkey", "c_nationkey").agg(F.count(F.lit(1)).alias("deliveries")))
    cte2 = top_per_group(cte1, ["c_nationkey"], "deliveries", ties=True)
    p = _t(spark, sf, "part")
    best = cte2.join(p, cte2.l_partkey == p.p_partkey)
    n = _t(spark, sf, "nation")
    return (best.join(n, best.c_nationkey == n.n_nationkey, "right")
                .select("n_name", F.coalesce("p_name", F.lit("No Sale")).alias("most_delivered_item")))


# Q15: array index path in a JSON document -------------------------------------------------
def delivery_documents(spark, sf) -> DataFrame:
    """One JSON delivery log per order, its lines in order (an order has a few lines
    by nature, so no document grows with the tables)."""
    l = _t(spark, sf, "lineitem")
    events = F.sort_array(F.collect_list(F.struct(
        F.col("l_linenumber").alias("Line"), F.col("l_returnflag").alias("Event"), qty().cast("string").alias("Comment"))))
    return l.groupBy("l_orderkey").agg(
        F.to_json(F.struct(events.alias("Events"))).alias("ReturnedDeliveryData"))


def q15_json_index(spark, sf):
    d = delivery_documents(spark, sf)
    second = d.select("l_orderkey", json_value("ReturnedDeliveryData", "$.Events[1].Comment").alias("comment"))
    return second.filter(F.col("comment").isNotNull())


# Q16 / Q17: JSON_VALUE equality and grouping -------------------------------------------------
def q16_json_value_eq(spark, sf):
    e = _t(spark, sf, "events")
    return e.filter(json_value("props", "$.k") == JSON_K_VALUE).select("user_id").distinct()


def q17_json_group(spark, sf):
    e = _t(spark, sf, "events").filter(F.col("event_type") == JSON_EVENT_TYPE)
    return (e.groupBy(json_value("props", "$.k").alias("k"))
             .agg(F.sum(money("value")).cast("double").alias("total_value")))


# Q18 / Q19: pivots over a fixed value list ------------------------------------------------------
def sales_by_type_year(spark, sf) -> DataFrame:
    l = _t(spark, sf, "lineitem")
    o = _t(spark, sf, "orders").filter(
        (F.col("o_orderdate") >= ts_lit(dt.datetime(PIVOT_YEARS[0], 1, 1)))
        & (F.col("o_orderdate") < ts_lit(dt.datetime(PIVOT_YEARS[-1] + 1, 1, 1))))
    p = _t(spark, sf, "part")
    return (l.join(o, l.l_orderkey == o.o_orderkey, "left")
             .join(p, l.l_partkey == p.p_partkey, "left")
             .filter(F.col("o_orderkey").isNotNull())
             .select("p_type", F.year("o_orderdate").alias("year"), qty().alias("quantity")))


def q18_pivot_years(spark, sf):
    return pivot_sum(sales_by_type_year(spark, sf), ["p_type"], "year", PIVOT_YEARS,
                     "quantity", names=[f"y{y}" for y in PIVOT_YEARS])


def q19_pivot_groups(spark, sf):
    return pivot_sum(sales_by_type_year(spark, sf), ["year"], "p_type", PIVOT_TYPES,
                     "quantity", names=[t.lower() for t in PIVOT_TYPES])


def register_views(spark: SparkSession, sf: str) -> list[str]:
    """CREATE VIEW for the two pivots (temporary views over the lazy plans)."""
    q18_pivot_years(spark, sf).createOrReplaceTempView("stock_quantity_by_year")
    q19_pivot_groups(spark, sf).createOrReplaceTempView("stock_quantity_by_group")
    return ["stock_quantity_by_year", "stock_quantity_by_group"]


# Q20: table function applied per order (CROSS APPLY) -------------------------------------------
def order_total(lineitem: DataFrame, with_tax: bool = False) -> DataFrame:
    """``OrderTotal(order)`` for every order at once: SUM(quantity * unit price)
    (= extended price), optionally with tax; exact DECIMAL(18,2) inputs."""
    amount = money("l_extendedprice")
    if with_tax:
        amount = amount * (F.lit(1) + F.col("l_tax").cast("decimal(18,3)"))
    return lineitem.groupBy("l_orderkey").agg(F.sum(amount).alias("total"))


def q20_tvf_apply(spark, sf):
    o = _t(spark, sf, "orders")
    t = order_total(_t(spark, sf, "lineitem"))
    return (o.join(t, t.l_orderkey == o.o_orderkey)
             .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                     F.col("total").cast("double").alias("total")))


def register_order_total_function(spark: SparkSession, lineitem_view: str = "lineitem") -> None:
    """SQL table function ``order_total(k)`` for use with LATERAL / CROSS APPLY style
    queries; Catalyst decorrelates the lateral call into an aggregate + hash join."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION order_total(k BIGINT)
        RETURNS TABLE (l_orderkey BIGINT, total DECIMAL(28,2))
        RETURN SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2)))
               FROM {lineitem_view} WHERE l_orderkey = k GROUP BY l_orderkey""")


# Q25 / Q26: FOR JSON PATH / FOR XML PATH of the Q19 pivot ---------------------------------------
def q25_for_json(spark, sf):
    pv = q19_pivot_groups(spark, sf)
    spec = {"Year": F.col("year")}
    spec.update({f"StockGroup.{t}": F.col(t.lower()) for t in PIVOT_TYPES})
    return pv.select("year", F.to_json(nested_json(spec)).alias("json"))


def q26_for_xml(spark, sf):
    pv = q19_pivot_groups(spark, sf)
    fields = [F.col("year").alias("_Year")] + [F.col(t.lower()).alias(t) for t in PIVOT_TYPES]
    return pv.select("year", F.to_xml(F.struct(*fields), {"rowTag": "StockItems"}).alias("xml"))
