"""Name -> job function for every registered query (the same names as the oracles)."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..streaming import file_stream
from . import exchange, incremental, medallion, misc, pipelines, purchase_orders, retail, warehouse

MODULES = (retail, incremental, purchase_orders, medallion, warehouse, misc, pipelines, exchange, file_stream)

NAMES = (
    "q01_or_join", "q02_join_residual", "q03_lapsed_customers", "q04_count_by_name",
    "q04_archive_count",
    "q05_len_filter", "q06_not_in_regions", "q07_avg_days", "q08_by_month",
    "q09_bought_gt_sold", "q10_having_like", "q11_between", "q12_wide_join",
    "q13_group_balance", "q14_top_item_by_city", "q15_json_index", "q16_json_value_eq",
    "q17_json_group", "q18_pivot_years", "q19_pivot_groups", "q20_tvf_apply",
    "q25_for_json", "q26_for_xml",
    "q21_load_date", "q23_load_week", "q23_with_tax", "q22_shred_json", "q24_scalar_or_array",
    "i_watermark_increment", "i_upsert", "i_insert_missing", "i_delete_matched", "x_topn",
    "m_bronze", "m_silver_clean", "m_quarantine", "m_genres", "m_genres_by_name", "m_unroll_genres", "m_junction",
    "m_languages",
    "m_bronze_status", "m_repaired", "m_repaired_status", "m_rerun", "m_repair_by_action", "x_null_profile",
    "w_pipeline", "w_customer_dim", "w_employee_dim", "w_stockitem_dim", "w_order_fact", "w_sales",
    "m_split_chunks", "c_clean_text", "k_surrogate_key", "x_union_by_name", "x_pk_check",
    "g07_config_loop", "g03_upsert_compacted", "g08_ods_to_parquet", "g05_retention_delete", "g14_gdpr_delete", "a13_activity_parts",
    "b01_batch_writer", "b02_lookup_writer", "a04_row_limit", "a05_read_by_path", "a07_new_records", "b05_schema_drift", "b15_views",
    "c03_duplicate_names", "c20_strict_split", "d11_ignore_spaces", "d13_repair_by_lookup", "e11_distinct_by_key",
    "l01_q07_ordered", "l01_q08_ordered", "l01_q19_ordered", "l04_preview", "l06_union_by_position",
    "f25_json_document", "f26_xml_document", "m_genre_keys", "m_language_keys", "m_junction_keys",
    "s_new_only", "s_drip_feed",
)


def jobs() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for name in NAMES:
        for mod in MODULES:
            fn = getattr(mod, name, None)
            if fn is not None:
                out[name] = fn
                break
        else:
            raise KeyError(f"no job named {name}")
    return out
