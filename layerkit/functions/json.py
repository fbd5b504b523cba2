"""JSON / XML column functions built on Spark's JSON and VARIANT expressions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_value(col, path: str) -> Column:
    """Scalar at ``path`` as text; objects and arrays give null (JSON_VALUE rules).

    ``get_json_object`` (a streaming parser; scalars keep their original text) is
    the fast path. Its result is ambiguous only when it starts with a brace or
    bracket: an object / array (-> null) or a string that merely begins that way;
    only those rows are parsed into VARIANT to tell the two apart.
    """
    c = _col(col)
    text = F.get_json_object(c, path)
    v = F.try_variant_get(F.try_parse_json(c), path, "variant")
    kind = F.schema_of_variant(v)
    nested = F.when(kind == "STRING", F.try_variant_get(v, "$", "string"))
    return F.when(text.startswith("{") | text.startswith("["), nested).otherwise(text)


def read_paths(df: DataFrame, col: str, paths: dict[str, tuple[str, str] | Column], keep: list[str] = ()) -> DataFrame:
    """Typed fields of a JSON column that is parsed once for each row.

    The text becomes a VARIANT in a projection of its own (Catalyst does not fold a parse
    into several readers), and every field is read from that: ``paths`` maps a name to
    (path, type), or to an expression on the column ``__doc``. A VARIANT column is taken as
    it is. A value that is no such type is null, as is any field of a malformed document."""
    variant = df.schema[col].dataType.simpleString() == "variant"
    doc = df.withColumn("__doc", F.col(col) if variant else F.try_parse_json(F.col(col)))
    fields = [(F.try_variant_get("__doc", *spec) if isinstance(spec, tuple) else spec).alias(name) for name, spec in paths.items()]
    return doc.select(*keep, *fields)


def array_or_scalar(col, path: str, elem_type: str = "int", parsed: bool = False) -> Column:
    """Field that is either ``[x, ...]`` or a single scalar, always as an array.

    Null when the field is missing or null, so a following ``explode`` drops it.
    ``parsed``: the column is a VARIANT already.
    """
    v = _col(col) if parsed else F.try_parse_json(_col(col))
    as_array = F.try_variant_get(v, path, f"array<{elem_type}>")
    scalar = F.try_variant_get(v, path, elem_type)
    return F.coalesce(as_array, F.when(scalar.isNotNull(), F.array(scalar)))


def nested_json(spec: dict[str, Column | str]) -> Column:
    """Struct from dotted names: ``{"Year": c, "StockGroup.Toys": c2}`` nests ``Toys``.

    Mirrors ``FOR JSON PATH`` aliases; field order follows first appearance.
    """
    tree: dict = {}
    for name, c in spec.items():
        node = tree
        parts = name.split(".")
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = _col(c)

    def build(node: dict) -> Column:
        return F.struct(*[(build(v) if isinstance(v, dict) else v).alias(k)
                          for k, v in node.items()])
    return build(tree)


def rows_to_json(df: DataFrame, spec: dict[str, Column | str], name: str = "json") -> DataFrame:
    """One JSON object per row (nulls omitted); the JSON array is the row set itself."""
    return df.select(F.to_json(nested_json(spec)).alias(name))


def rows_to_xml(df: DataFrame, row_tag: str, attributes: dict[str, Column | str],
                elements: dict[str, Column | str], name: str = "xml") -> DataFrame:
    """One ``<row_tag attr="..">`` element per row (``FOR XML PATH``); nulls omitted."""
    fields = [_col(c).alias(f"_{k}") for k, c in attributes.items()]
    fields += [_col(c).alias(k) for k, c in elements.items()]
    return df.select(F.to_xml(F.struct(*fields), {"rowTag": row_tag}).alias(name))
