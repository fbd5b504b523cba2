"""Purchase-order JSON (one field scalar-or-array) into new stock items (Q24)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import array_or_scalar, read_paths
from ..operators.keys import continue_key
from ..sources.tables import load

ORDERS_PER_DOCUMENT = 100


def purchase_order_documents(spark: SparkSession, sf: str) -> DataFrame:
    """``{"PurchaseOrders": [...]}`` documents derived from ``part``, at most
    ORDERS_PER_DOCUMENT orders each. ``OuterPackageId`` is an int array for even
    sizes and a text scalar otherwise; every 50th order date is malformed text."""
    p = load(spark, sf, "part")
    pkg = F.when(F.col("p_size") % 2 == 0,
                 F.to_json(F.array(F.col("p_size"), F.col("p_size") + 1))) \
           .otherwise(F.concat(F.lit('"'), F.col("p_size").cast("string"), F.lit('"')))
    day = F.date_format(F.date_add(F.lit("2018-01-01").cast("date"), (F.col("p_partkey") % 28).cast("int")),
                        "yyyy-MM-dd")
    order_date = F.when(F.col("p_partkey") % 50 == 0, F.lit("2018-01-025")).otherwise(day)
    fixed = F.to_json(F.struct(
        F.col("p_name").alias("StockItemName"),
        F.regexp_extract("p_brand", r"(\d+)", 1).alias("Supplier"),
        F.lit("1").alias("UnitPackageId"),
        F.col("p_brand").alias("Brand"),
        F.col("p_retailprice").cast("decimal(18,2)").cast("string").alias("UnitPrice"),
        order_date.alias("OrderDate"),
        F.col("p_partkey").cast("string").alias("SupplierReference")))
    # the package field has two shapes, so it is spliced into the object text
    po = F.concat(F.regexp_replace(fixed, r"\}$", ""), F.lit(',"OuterPackageId":'), pkg, F.lit("}"))
    docs = (p.select(F.floor(F.col("p_partkey") / ORDERS_PER_DOCUMENT).alias("doc_no"), po.alias("po"))
             .groupBy("doc_no")
             .agg(F.concat(F.lit('{"PurchaseOrders":['), F.concat_ws(",", F.collect_list("po")),
                           F.lit("]}")).alias("doc")))
    return docs


def shred_purchase_orders(docs: DataFrame) -> DataFrame:
    """OPENJSON(doc, '$.PurchaseOrders') WITH (...) plus the scalar-or-array package
    field expanded to one row per package id (UNION ALL of both shapes). A document is
    parsed once; its orders and their fields are read from the parsed value."""
    orders = read_paths(docs, "doc", {"orders": ("$.PurchaseOrders", "array<variant>")})
    # outer, then filtered: a plain explode would test the array's size in a second parse
    each = orders.select(F.explode_outer("orders").alias("po")).where("po IS NOT NULL")
    typed = read_paths(each, "po", {
        "StockItemName": ("$.StockItemName", "string"), "SupplierID": ("$.Supplier", "int"),
        "UnitPackageID": ("$.UnitPackageId", "int"), "packages": array_or_scalar("__doc", "$.OuterPackageId", "int", parsed=True),
        "Brand": ("$.Brand", "string"), "UnitPrice": ("$.UnitPrice", "decimal(18,2)"), "OrderDate": ("$.OrderDate", "date"),
        "SupplierReference": ("$.SupplierReference", "bigint")})
    return typed.select("*", F.explode("packages").alias("OuterPackageID")).drop("packages")


def q24_scalar_or_array(spark: SparkSession, sf: str) -> DataFrame:
    rows = shred_purchase_orders(purchase_order_documents(spark, sf))
    keyed = continue_key(rows, load(spark, sf, "part"), "p_partkey",
                         ["SupplierReference", "OuterPackageID"], "StockItemID")
    top = load(spark, sf, "part").agg(F.max("p_partkey")).scalar()
    return keyed.select(
        "StockItemID",
        F.concat(F.col("StockItemName"), F.lit("("), (F.col("StockItemID") - top).cast("string"),
                 F.lit(")")).alias("StockItemName"),
        "SupplierID", "UnitPackageID", "OuterPackageID", "Brand",
        F.col("UnitPrice").cast("double").alias("UnitPrice"), "OrderDate",
        F.lit(False).alias("IsChillerStock"))
