"""Link, path and parameter extraction from page and script text (P12-P17,
O06, U04).

Patterns are parameters (defaults in `constants`); all work is
`regexp_extract_all` plus higher-order array functions per row, so a page
is one row in one task and nothing is collected across rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (CALL_URL_PREFIXES, FETCH_URL_PATTERN, HEADER_NAME_PATTERN,
                         LINK_REL_PATTERN, PATH_LITERAL_PATTERN, QUERY_PARAM_PATTERN,
                         SCRIPT_KEEP_CONTAINS, SCRIPT_KEEP_SUFFIX, SCRIPT_MAX,
                         SCRIPT_SRC_PATTERN)
from ..functions.text import extract_all, extract_first


def script_srcs(pages: DataFrame, text: str = "html", key: str = "page_id",
                pattern: str = SCRIPT_SRC_PATTERN, keep_suffix: str | None = SCRIPT_KEEP_SUFFIX,
                keep_contains: str | None = SCRIPT_KEEP_CONTAINS,
                max_per_page: int | None = SCRIPT_MAX) -> DataFrame:
    """Script sources per page, kept when they end with `.js` or
    contain `assets/`, first `max_per_page` in document order."""
    found = extract_all(F.col(text), pattern)
    if keep_suffix is not None or keep_contains is not None:
        def keep(s):
            c = F.lit(False)
            if keep_suffix is not None:
                c = c | s.endswith(keep_suffix)
            if keep_contains is not None:
                c = c | s.contains(keep_contains)
            return c
        found = F.filter(found, keep)
    if max_per_page is not None:
        found = F.slice(found, 1, max_per_page)
    return pages.select(key, F.posexplode(found).alias("pos", "src"))


def call_urls(pages: DataFrame, text: str = "html", key: str = "page_id",
              pattern: str = FETCH_URL_PATTERN, prefixes=CALL_URL_PREFIXES) -> DataFrame:
    """URL literals passed to `fetch(...)`; `is_endpoint` marks the
    ones under an API prefix (the source keeps only those)."""
    rows = pages.select(key, F.posexplode(extract_all(F.col(text), pattern)).alias("pos", "url"))
    ep = F.lit(False)
    for p in prefixes:
        ep = ep | F.col("url").startswith(p)
    return rows.withColumn("is_endpoint", ep)


def path_literals(pages: DataFrame, text: str = "html", key: str = "page_id",
                  pattern: str = PATH_LITERAL_PATTERN, fetch_pattern: str = FETCH_URL_PATTERN,
                  prefixes=CALL_URL_PREFIXES) -> DataFrame:
    """Distinct quoted API path literals per page that the
    `fetch(...)` scan did not already find."""
    fetched = F.filter(extract_all(F.col(text), fetch_pattern),
                       lambda u: _starts_any(u, prefixes))
    paths = F.array_except(F.array_distinct(extract_all(F.col(text), pattern)), fetched)
    return pages.select(key, F.explode(paths).alias("path"))


def _starts_any(col, prefixes):
    c = F.lit(False)
    for p in prefixes:
        c = c | col.startswith(p)
    return c


def query_params(pages: DataFrame, text: str = "url", key: str = "page_id",
                 pattern: str = QUERY_PARAM_PATTERN) -> DataFrame:
    """Distinct query-parameter names per row."""
    return pages.select(key, F.explode(F.array_distinct(extract_all(F.col(text), pattern)))
                        .alias("param"))


def header_names(pages: DataFrame, text: str = "html", key: str = "page_id",
                 pattern: str = HEADER_NAME_PATTERN) -> DataFrame:
    """Distinct quoted ``Word-Word`` names used as object keys."""
    return pages.select(key, F.explode(F.array_distinct(extract_all(F.col(text), pattern)))
                        .alias("header"))


def link_rel_url(df: DataFrame, text: str = "link", pattern: str = LINK_REL_PATTERN,
                 keep: list[str] | None = None) -> DataFrame:
    """URL of a `Link` header entry with rel stream / export / bulk /
    download (NULL when there is none)."""
    keep = keep or []
    return df.select(*keep, extract_first(F.col(text), pattern, 1).alias("url"))
