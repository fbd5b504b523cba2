from .aggregates import (distinct_by_key, dedup_keep_first, duplicate_keys, null_profile,
                         pivot_sum, top_per_group)
from .joins import anti_join_not_in, match_join, or_join, repair_by_lookup, salted_join, skew_join
from .keys import add_surrogate_key, continue_key, register_members
from .increments import compact, latest, load_increment
from .merge import (apply_actions, apply_actions_to, apply_merge, delete_where, drop_partitions_where, merge_delete,
                    merge_insert, merge_update, merge_upsert, overwrite_partitions)
from .projection import map_columns, mark_rows, union_by_position
from .rewrite import delete_matching, delete_where_in, finish_rewrite, read_files
from .split import split_chunks, split_rows

__all__ = [
    "distinct_by_key", "dedup_keep_first", "duplicate_keys", "null_profile", "pivot_sum",
    "top_per_group", "anti_join_not_in", "or_join", "repair_by_lookup", "salted_join",
    "add_surrogate_key", "continue_key", "apply_merge", "delete_where",
    "drop_partitions_where", "merge_delete", "merge_insert", "merge_update",
    "merge_upsert", "overwrite_partitions", "split_chunks", "split_rows", "map_columns",
    "mark_rows", "skew_join", "compact", "latest", "load_increment", "apply_actions", "apply_actions_to",
    "delete_matching", "delete_where_in", "finish_rewrite", "read_files", "match_join", "register_members",
    "union_by_position",
]
