from .dates import avg_int, days_between, ts_lit, year_range
from .json import array_or_scalar, json_value, nested_json, rows_to_json, rows_to_xml
from .text import capitalize_first, clean_people, replace_literal, strip_all

__all__ = [
    "avg_int", "days_between", "ts_lit", "year_range", "array_or_scalar", "json_value",
    "nested_json", "rows_to_json", "rows_to_xml", "capitalize_first", "clean_people",
    "replace_literal", "strip_all",
]
