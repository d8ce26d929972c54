"""String classification and pattern extraction (P10, P12-P18) as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (AUTH_STATUSES, BASE64_PATTERN, NUMERIC_PATTERN, THROTTLED_STATUS,
                         UUID_LOOSE_PATTERN)
from .json import _c


def string_format_class(col) -> Column:
    """P10: ``base64`` / ``numeric`` / ``uuid`` / ``opaque``, tested in that order.

    Order matters: a run of digits matches the base64 alphabet first.
    """
    s = _c(col)
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(s.rlike(BASE64_PATTERN), F.lit("base64"))
            .when(s.rlike(NUMERIC_PATTERN), F.lit("numeric"))
            .when(s.rlike(UUID_LOOSE_PATTERN), F.lit("uuid"))
            .otherwise(F.lit("opaque")))


def extract_all(col, pattern: str, group: int = 1) -> Column:
    """Every match of `pattern` (capture `group`) in document order."""
    return F.regexp_extract_all(_c(col), F.lit(pattern), F.lit(group))


def extract_first(col, pattern: str, group: int = 1) -> Column:
    """First match of `pattern` or NULL (not the empty string)."""
    m = F.regexp_extract(_c(col), pattern, group)
    return F.when(_c(col).rlike(pattern), m)


def request_outcome(status) -> Column:
    """``auth`` / ``throttled`` / ``server`` / ``client`` / ``ok``."""
    s = _c(status)
    return (F.when(s.isin(*AUTH_STATUSES), F.lit("auth"))
            .when(s == THROTTLED_STATUS, F.lit("throttled"))
            .when(s >= 500, F.lit("server"))
            .when(s >= 400, F.lit("client"))
            .otherwise(F.lit("ok")))
