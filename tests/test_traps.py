"""Semantic traps the oracle data does not reach."""
from pyspark.sql import functions as F

from layerkit.plans import purchase_orders, retail
from layerkit.sources.tables import load
from tests.conftest import SF_SMALL


def test_q14_cities_without_sales_print_no_sale(spark):
    out = retail.q14_top_item_by_city(spark, SF_SMALL, year=1990).collect()
    nations = load(spark, SF_SMALL, "nation").count()
    assert len(out) == nations and {r.most_delivered_item for r in out} == {"No Sale"}


def test_q24_malformed_date_is_null_not_an_error(spark):
    rows = purchase_orders.shred_purchase_orders(purchase_orders.purchase_order_documents(spark, SF_SMALL))
    bad = rows.filter(F.col("SupplierReference") % 50 == 0)
    assert bad.count() > 0 and bad.filter(F.col("OrderDate").isNotNull()).count() == 0
    # the array form yields two rows per order, the scalar form one
    per_order = dict(rows.groupBy("SupplierReference").count().collect())
    sizes = dict(load(spark, SF_SMALL, "part").select("p_partkey", "p_size").collect())
    assert all(n == (2 if sizes[k] % 2 == 0 else 1) for k, n in per_order.items())
