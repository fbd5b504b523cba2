from .files import (layer_path, read_config, read_json_array, read_new, read_table,
                    read_tsv, read_typed_json)
from .jdbc import read_jdbc, write_jdbc
from .tables import TABLES, load, register_views
from .writers import (batch_writer, lookup_writer, register_table, write_batch,
                      write_bucketed, write_json, write_parquet)

__all__ = [
    "TABLES", "load", "register_views", "layer_path", "read_config", "read_json_array", "read_new",
    "read_table", "read_tsv", "read_typed_json", "read_jdbc", "write_jdbc",
    "batch_writer", "lookup_writer", "register_table", "write_batch", "write_json",
    "write_parquet", "write_bucketed",
]
