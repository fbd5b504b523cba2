"""Row routing: clean / quarantine splits and fixed-count chunking."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import add_surrogate_key


def split_rows(df: DataFrame, rule: Column, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows passing ``rule``, all other rows).

    Default: a null rule result goes to the second branch (first match wins, the
    rest goes last). ``strict=True`` reproduces two independent filters ``rule`` /
    ``NOT rule`` where rows with a null result land in neither.
    """
    if strict:
        return df.filter(rule), df.filter(~rule)
    ok = F.coalesce(rule, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def split_chunks(df: DataFrame, order_by: list[str], n: int = 8,
                 keep_remainder: bool = True, name: str = "chunk") -> DataFrame:
    """Tag rows with chunk ``0..n-1`` of ``floor(count/n)`` consecutive rows each.

    The rows past ``n * floor(count/n)`` go to the last chunk (all rows do when there
    are fewer than ``n``); ``keep_remainder=False`` drops them, as the original split
    does. Positions come from the parallel surrogate-key assignment, the count from a
    scalar subquery.
    """
    pos = add_surrogate_key(df, order_by, "__pos", start=0)
    per = F.floor(df.select(F.count(F.lit(1))).scalar() / F.lit(n))
    chunk = F.when(per > 0, F.floor(F.col("__pos") / per))
    if keep_remainder:
        chunk = F.coalesce(F.least(chunk, F.lit(n - 1)), F.lit(n - 1))
    out = pos.withColumn(name, chunk.cast("int")).filter(F.col(name) < n)
    return out.drop("__pos")
