"""Text cleaning with built-in column functions (no Python per row)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip_all(c) -> Column:
    """Remove leading and trailing whitespace of any kind (blank, tab, newline)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def capitalize_first(c) -> Column:
    """First character upper case, the rest lower case (not title case)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def replace_literal(c, old: str, new: str = "") -> Column:
    """Literal (non-regex) replacement of every occurrence."""
    c = F.col(c) if isinstance(c, str) else c
    return F.replace(c, F.lit(old), F.lit(new))


# The address markers removed by the cleaning step.
ADDRESS_MARKERS = ("No.", "#")


def clean_people(df: DataFrame, capitalize_cols=("FirstName", "LastName"),
                 phone_col: str = "Phone", address_col: str = "Address") -> DataFrame:
    """Strip every column, capitalise names, drop dashes from phones and markers
    from addresses, then remove rows that became identical."""
    out = df.select(*[strip_all(c).alias(c) for c in df.columns])
    out = out.withColumns({c: capitalize_first(c) for c in capitalize_cols})
    out = out.withColumn(phone_col, replace_literal(phone_col, "-"))
    addr = F.col(address_col)
    for marker in ADDRESS_MARKERS:
        addr = replace_literal(addr, marker)
    return out.withColumn(address_col, addr).dropDuplicates()
