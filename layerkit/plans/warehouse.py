"""Star-schema build (dimensions and facts) from operational tables.

Stand-ins: supplier rows are the people (contacts / employees); a customer's
primary contact is the lowest-key person of its nation, its bill-to customer is
the lowest-key customer of the same nation and segment (a self join). Both
joins are inner, so customers without a contact or bill-to drop out.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.projection import map_columns
from ..schemas import conform
from ..sources.tables import load

CUSTOMER_DIM = (
    "SourceCustomerID BIGINT, Customer STRING, BillToCustomerID BIGINT, BillToCustomer STRING, "
    "CustomerCategory STRING, BuyingGroupID INT, PrimaryContact STRING")
EMPLOYEE_DIM = (
    "SourceEmployeeID BIGINT, Employee STRING, PreferredName STRING, IsSalesperson BOOLEAN")
STOCKITEM_DIM = (
    "SourceStockItemID BIGINT, StockItem STRING, Brand STRING, Size STRING, "
    "StockGroup STRING, UnitPrice DOUBLE")
ORDER_FACT = (
    "SourceOrderID BIGINT, SourceOrderLineID INT, CustomerKey BIGINT, StockItemKey BIGINT, "
    "SalespersonKey BIGINT, OrderDate DATE, PickedDate DATE, Quantity BIGINT, "
    "TotalExcludingTax DOUBLE, TaxRate DOUBLE")
SALE_FACT = (
    "SourceInvoiceID BIGINT, CustomerKey BIGINT, InvoiceDate DATE, InvoiceStatus STRING, "
    "Priority STRING, TotalIncludingTax DOUBLE")


# Column maps (target = source), qualified by the alias of the stream they come from.
CUSTOMER_MAP = [
    ("SourceCustomerID", "cust.c_custkey"), ("Customer", "cust.c_name"),
    ("BillToCustomerID", "billto.c_custkey"), ("BillToCustomer", "billto.c_name"),
    ("CustomerCategory", "cust.c_mktsegment"), ("BuyingGroupID", "cust.c_nationkey"),
    ("PrimaryContact", "contact.s_name"),
]
def _employee_map() -> list:
    return [
        ("SourceEmployeeID", "s_suppkey"), ("Employee", "s_name"),
        ("PreferredName", F.split("s_name", "#")[1]), ("IsSalesperson", F.col("s_acctbal") > 5000),
    ]
def _stockitem_map() -> list:
    return [
        ("SourceStockItemID", "p_partkey"), ("StockItem", "p_name"), ("Brand", "p_brand"),
        ("Size", F.col("p_size").cast("string")), ("StockGroup", "p_type"),
        ("UnitPrice", F.col("p_retailprice").cast("decimal(18,2)").cast("double")),
    ]
def _order_fact_map() -> list:
    return [
        ("SourceOrderID", "o.o_orderkey"), ("SourceOrderLineID", "l.l_linenumber"),
        ("CustomerKey", "o.o_custkey"), ("StockItemKey", "l.l_partkey"),
        ("SalespersonKey", "l.l_suppkey"), ("OrderDate", F.col("o.o_orderdate").cast("date")),
        ("PickedDate", F.col("l.l_shipdate").cast("date")),
        ("Quantity", F.col("l.l_quantity").cast("long")),
        ("TotalExcludingTax", F.col("l.l_extendedprice").cast("decimal(18,2)").cast("double")),
        ("TaxRate", "l.l_tax"),
    ]
def _sale_map() -> list:
    return [
        ("SourceInvoiceID", "o_orderkey"), ("CustomerKey", "o_custkey"),
        ("InvoiceDate", F.col("o_orderdate").cast("date")), ("InvoiceStatus", "o_orderstatus"),
        ("Priority", "o_orderpriority"), ("TotalIncludingTax", "o_totalprice"),
    ]


def build_customer_dim(customer: DataFrame, people: DataFrame) -> DataFrame:
    first = people.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("contact_id"))
    contact = people.join(first.select("contact_id"), F.col("s_suppkey") == F.col("contact_id"))
    head = customer.groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_custkey").alias("bill_to_id"))
    c = customer.alias("cust")
    j = (c.join(contact.alias("contact"), F.col("cust.c_nationkey") == F.col("contact.s_nationkey"))
          .join(head.alias("head"), (F.col("cust.c_nationkey") == F.col("head.c_nationkey"))
                & (F.col("cust.c_mktsegment") == F.col("head.c_mktsegment")))
          .join(customer.alias("billto"), F.col("head.bill_to_id") == F.col("billto.c_custkey")))
    return conform(map_columns(j, CUSTOMER_MAP), CUSTOMER_DIM)


def build_employee_dim(people: DataFrame) -> DataFrame:
    return conform(map_columns(people.filter(F.col("s_acctbal") >= 0), _employee_map()), EMPLOYEE_DIM)


def build_stockitem_dim(part: DataFrame) -> DataFrame:
    return conform(map_columns(part, _stockitem_map()), STOCKITEM_DIM)


def build_order_fact(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    j = lineitem.alias("l").join(orders.alias("o"), F.col("l.l_orderkey") == F.col("o.o_orderkey"))
    return conform(map_columns(j, _order_fact_map()), ORDER_FACT)


def build_sales(orders: DataFrame) -> DataFrame:
    return conform(map_columns(orders, _sale_map()), SALE_FACT)


def w_customer_dim(spark: SparkSession, sf: str):
    return build_customer_dim(load(spark, sf, "customer"), load(spark, sf, "supplier"))


def w_employee_dim(spark, sf):
    return build_employee_dim(load(spark, sf, "supplier"))


def w_stockitem_dim(spark, sf):
    return build_stockitem_dim(load(spark, sf, "part"))


def w_order_fact(spark, sf):
    return build_order_fact(load(spark, sf, "lineitem"), load(spark, sf, "orders"))


def w_sales(spark, sf):
    return build_sales(load(spark, sf, "orders"))


# ------------------------------------------------------------------ end-to-end flow
ODS_TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DECIMAL(18,2), "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DECIMAL(18,2)",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DECIMAL(18,2)",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DECIMAL(18,2), "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DECIMAL(18,2), l_tax DOUBLE, l_shipdate TIMESTAMP_NTZ",
}


def ods_to_integration(spark: SparkSession, ods_root: str, out_root: str) -> dict[str, str]:
    """Five integration sinks built from one read of the ODS parquet layer.

    The builds share their inputs but not their work, so they are submitted as
    concurrent Spark jobs; a failure in any of them fails the step.
    """
    from concurrent.futures import ThreadPoolExecutor

    from ..sources.files import layer_path
    from ..sources.writers import write_parquet

    ods = {t: spark.read.parquet(layer_path(ods_root, "ODS", t)) for t in ODS_TABLES}
    builds = {
        "customer_dim": lambda: build_customer_dim(ods["customer"], ods["supplier"]),
        "employee_dim": lambda: build_employee_dim(ods["supplier"]),
        "stockitem_dim": lambda: build_stockitem_dim(ods["part"]),
        "order_fact": lambda: build_order_fact(ods["lineitem"], ods["orders"]),
        "sales": lambda: build_sales(ods["orders"]),
    }
    paths = {name: layer_path(out_root, "Integration", name) for name in builds}
    with ThreadPoolExecutor(max_workers=len(builds)) as pool:
        futures = [pool.submit(lambda n=n: write_parquet(builds[n](), paths[n])) for n in builds]
        for f in futures:
            f.result()
    return paths


def w_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """ODS copies (typed) -> integration layer; every row of the five written sinks."""
    from ..session import new_run_dir
    from ..sources.files import layer_path
    from ..sources.writers import write_parquet

    root = new_run_dir(spark, "warehouse")
    for t, ddl in ODS_TABLES.items():
        write_parquet(conform(load(spark, sf, t), ddl), layer_path(root, "ODS", t))
    out = None
    for name, path in ods_to_integration(spark, root, root).items():
        rows = spark.read.parquet(path).select(F.lit(name).alias("sink"), "*")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
