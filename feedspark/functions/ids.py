"""Id extraction.

The source reads an id as the first *truthy* value among candidate fields
and stringifies it, so ``0``, ``false``, ``""`` and ``null`` fall through
while the string ``"0"`` does not. Telling ``0`` from ``"0"`` needs the
Variant type tag, which `get_json_object` cannot give.

`with_id_pick` stages the work in projections (candidate values, then
their kinds, then truthiness, then the pick). Catalyst does not collapse a
projection whose non-trivial outputs are used more than once, so each
candidate is looked up and classified once per row and the generated code
stays linear in the number of candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ID_FIELDS, ID_SENTINELS, UUID_STRICT_PATTERN
from .json import _c, field_path, truthy_of, vget, vkind, vtext


def with_id_pick(df: DataFrame, v: str = "v", fields=ID_FIELDS, id_col: str = "id",
                 field_col: str | None = "id_field", kind_col: str | None = "id_kind") -> DataFrame:
    """Add the first truthy candidate of variant column `v`: its text
    (`id_col`), the field it came from and its JSON kind.

    An object or array is truthy in the source but stringifies to nonsense
    (``[object Object]``), so its id is NULL here; `invalid_reason`
    quarantines it.
    """
    n = len(fields)
    cand = [f"_ic{i}" for i in range(n)]
    kind = [f"_ik{i}" for i in range(n)]
    tru = [f"_it{i}" for i in range(n)]
    df = df.select("*", *[vget(F.col(v), field_path(f)).alias(c) for f, c in zip(fields, cand)])
    df = df.select("*", *[vkind(F.col(c)).alias(k) for c, k in zip(cand, kind)])
    df = df.select("*", *[truthy_of(F.col(c), F.col(k)).alias(t)
                          for c, k, t in zip(cand, kind, tru)])
    text = F.coalesce(*[F.when(F.col(t), vtext(F.col(c))) for t, c in zip(tru, cand)])
    fld = F.coalesce(*[F.when(F.col(t), F.lit(f)) for t, f in zip(tru, fields)])
    knd = F.coalesce(*[F.when(F.col(t), F.col(k)) for t, k in zip(tru, kind)])
    df = df.select("*", text.alias("_itext"), fld.alias("_ifield"), knd.alias("_ikind"))
    df = df.withColumn(id_col, F.when(~F.col("_ikind").isin("object", "array"), F.col("_itext")))
    if field_col:
        df = df.withColumnRenamed("_ifield", field_col)
    if kind_col:
        df = df.withColumnRenamed("_ikind", kind_col)
    return df.drop(*cand, *kind, *tru, "_itext", "_ifield", "_ikind")


def with_element_id(df: DataFrame, e: str = "_e", fields=ID_FIELDS, id_col: str = "id") -> DataFrame:
    """Id of one array element held in variant column `e`: a string element
    is the id; an object goes through the candidate pick; anything else
    yields nothing."""
    df = df.withColumn("_ek", vkind(F.col(e)))
    df = with_id_pick(df, e, fields, id_col="_epick", field_col=None, kind_col=None)
    return (df.withColumn(id_col, F.when(F.col("_ek") == "string", vtext(F.col(e)))
                          .when(F.col("_ek") == "object", F.col("_epick")))
            .drop("_ek", "_epick"))


def is_valid_id(id_col, sentinels=ID_SENTINELS) -> Column:
    """P02 predicate: non-empty and not a sentinel (checked after the pick)."""
    i = _c(id_col)
    return i.isNotNull() & (i != F.lit("")) & ~i.isin(*sentinels)


def invalid_reason(id_col="id", kind_col="id_kind", parsed_ok=None,
                   sentinels=ID_SENTINELS) -> Column:
    """Why a record yields no id; NULL for a good record.

    Reasons: ``unparsable``, ``object_id``, ``no_id``, ``sentinel``.
    """
    i, k = _c(id_col), _c(kind_col)
    r = (F.when(k.isin("object", "array"), F.lit("object_id"))
         .when(i.isNull() | (i == F.lit("")), F.lit("no_id"))
         .when(i.isin(*sentinels), F.lit("sentinel")))
    if parsed_ok is not None:
        r = F.when(~_c(parsed_ok), F.lit("unparsable")).otherwise(r)
    return r


def is_uuid(col, pattern: str = UUID_STRICT_PATTERN) -> Column:
    """Strict 8-4-4-4-12 hex form."""
    return F.coalesce(_c(col).rlike(pattern), F.lit(False))


def string_id(col) -> Column:
    """Typed id column to the text id the loader keys on (no truthiness rule)."""
    return _c(col).cast("string")
