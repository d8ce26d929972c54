"""Integer arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a, b) -> Column:
    """Integer division truncating toward zero (SQL ``a div b``), exact for BIGINT."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.lit(b) if isinstance(b, int) else b
    return F.call_function("div", a, b)


def keep_rows(df, cond: Column):
    """Keep the rows where `cond` holds, evaluated on `df`'s computed columns.

    A plain `where` is pushed below the projections that compute its inputs,
    inlining their expressions at every level; over staged Variant parsing
    that multiplies the expression tree. A generator is not pushed through,
    so this filter reads each computed column once.
    """
    return df.select("*", F.explode(F.when(cond, F.array(F.lit(True)))).alias("_keep")).drop("_keep")
