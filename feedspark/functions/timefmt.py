"""Time helpers: epoch milliseconds, mixed-format classification (P06) and
normalisation (P07)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (ISO_PREFIX_PATTERN, UNIX_MILLIS_LO_EXCL, UNIX_SECONDS_HI_EXCL,
                         UNIX_SECONDS_LO_EXCL)
from .json import _c, vkind
from .num import idiv


def epoch_ms(ts) -> Column:
    """Truncating epoch milliseconds of a TIMESTAMP or TIMESTAMP_NTZ column.

    `unix_micros div 1000` truncates like DuckDB's `epoch_us // 1000`
    (DuckDB's `epoch_ms` rounds, Spark's `unix_millis` truncates).
    """
    return idiv(F.unix_micros(_c(ts).cast("timestamp")), 1000)


def ms_to_ts(ms) -> Column:
    return F.timestamp_millis(_c(ms))


def ts_format_class(v) -> Column:
    """P06 on a variant value: ``iso``, ``unix_s``, ``unix_ms``, ``unknown`` or NULL (absent).

    ISO by a ``YYYY-MM-DD`` text prefix; numbers strictly between 1e9 and 2e9
    are seconds, above 1e12 milliseconds; everything else (1e9 itself,
    2e9..1e12, other strings, booleans) is unknown.
    """
    v = _c(v)
    kind = vkind(v)
    s = F.try_variant_get(v, "$", "string")
    d = F.try_variant_get(v, "$", "double")
    return (F.when(kind.isin("missing", "null"), F.lit(None).cast("string"))
            .when((kind == "string") & s.rlike(ISO_PREFIX_PATTERN), F.lit("iso"))
            .when((kind == "number") & (d > UNIX_SECONDS_LO_EXCL) & (d < UNIX_SECONDS_HI_EXCL),
                  F.lit("unix_s"))
            .when((kind == "number") & (d > UNIX_MILLIS_LO_EXCL), F.lit("unix_ms"))
            .otherwise(F.lit("unknown")))


def ts_normalise(v) -> Column:
    """One instant (TIMESTAMP) from ISO text, Unix seconds or Unix ms; NULL if unknown."""
    v = _c(v)
    cls = ts_format_class(v)
    s = F.try_variant_get(v, "$", "string")
    d = F.try_variant_get(v, "$", "double")
    return (F.when(cls == "iso", F.try_to_timestamp(s))
            .when(cls == "unix_s", F.timestamp_micros((d * F.lit(1_000_000)).cast("long")))
            .when(cls == "unix_ms", F.timestamp_micros((d * F.lit(1000)).cast("long"))))
