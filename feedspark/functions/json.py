"""JSON column helpers on Spark's Variant type.

`try_parse_json` alone accepts an object followed by junk
(``{"id":"a"} junk``); wrapping the text in brackets and asking for a
one-element array refuses that, the way a strict parser does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def wrap_parse(text) -> Column:
    """Parse of ``[text]``: a one-element array exactly when `text` is one JSON value."""
    return F.try_parse_json(F.concat(F.lit("["), _c(text), F.lit("]")))


def unwrap(wrapped) -> Column:
    """The single value of a `wrap_parse` result, NULL when it held 0 or 2+ values.

    ``$[1]`` is SQL NULL only when there is no second element (a JSON null
    element is a variant null, not SQL NULL), so no array is materialised.
    """
    w = _c(wrapped)
    return F.when(F.try_variant_get(w, "$[1]", "variant").isNull(),
                  F.try_variant_get(w, "$[0]", "variant"))


def _closed_once(text) -> Column:
    """False if an array wrapped around `text` could be closed by a bracket of its own
    (``"x"] junk``): then an object wrapped around it does not parse. Only texts with a
    closing bracket need that second parse."""
    t = _c(text)
    return F.when(F.contains(t, F.lit("]")), F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}"))).isNotNull()
                  ).otherwise(F.lit(True))


def strict_parse(text) -> Column:
    """Variant of a whole JSON text, or NULL if the text is not exactly one value.

    As one expression the parse appears twice; `with_strict_parse` stages it
    so each row is parsed once.
    """
    return F.when(_closed_once(text), unwrap(wrap_parse(text)))


def with_strict_parse(df, text: str, out: str = "v"):
    """Add `out` = strict parse of column `text`, parsing each row once. Of a repeated key
    the last value counts, as in JavaScript: one rule for every reader, whichever was
    called first (Spark takes it from the session only, so it is set wherever text is parsed)."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return df.withColumn("_wrapped", F.when(_closed_once(text), wrap_parse(text))).withColumn(
        out, unwrap("_wrapped")).drop("_wrapped")


def vget(v, path: str) -> Column:
    """Variant at `path`; NULL when the path is absent (JSON null stays a variant)."""
    return F.try_variant_get(_c(v), path, "variant")


def field_path(name: str) -> str:
    """JSON path for a top-level key, quoting names that are not plain identifiers."""
    if name.replace("_", "a").isalnum() and not name[0].isdigit():
        return f"$.{name}"
    return "$['" + name.replace("'", "\\'") + "']"


def vkind(v) -> Column:
    """JSON kind of a variant: missing / null / string / number / boolean / object / array."""
    v = _c(v)
    # The type tag is computed once: its first three letters pick the kind
    # (CASE branches after the first are not shared by subexpression elimination).
    tag3 = F.substring(F.schema_of_variant(v), 1, 3)
    kinds = F.create_map(*[F.lit(x) for x in ("STR", "string", "BOO", "boolean", "OBJ", "object",
                                              "ARR", "array", "VOI", "null")])
    return (F.when(v.isNull(), F.lit("missing"))
            .otherwise(F.coalesce(F.element_at(kinds, tag3), F.lit("number"))))


def vtext(v) -> Column:
    """Text of a scalar variant the way JavaScript's String() writes it.

    Integral doubles (``1e3``) print without a fraction; the rest uses
    Spark's cast, which agrees with JavaScript for integers and plain decimals.
    """
    v = _c(v)
    s = F.try_variant_get(v, "$", "string")
    d = F.try_variant_get(v, "$", "double")
    integral_double = ((F.schema_of_variant(v) == "DOUBLE") & (d == F.floor(d))
                       & (F.abs(d) < F.lit(1e21)))
    return F.when(integral_double, d.try_cast("decimal(38,0)").cast("string")).otherwise(s)


def vtruthy(v) -> Column:
    """JavaScript truthiness of a variant value (missing counts as undefined)."""
    return truthy_of(_c(v), vkind(v))


def truthy_of(v, kind) -> Column:
    """Truthiness of variant `v` whose kind (`vkind`) is already computed."""
    v, kind = _c(v), _c(kind)
    s = F.try_variant_get(v, "$", "string")
    return (F.when(kind.isin("missing", "null"), F.lit(False))
            .when(kind == "string", s != F.lit(""))
            .when(kind == "boolean", s == F.lit("true"))
            .when(kind == "number", F.try_variant_get(v, "$", "double") != F.lit(0.0))
            .otherwise(F.lit(True)))


def top_keys(v) -> Column:
    """Array of the top-level keys of an object variant (NULL for non-objects)."""
    return F.json_object_keys(F.to_json(_c(v)))
