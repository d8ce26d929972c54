"""Text payload sources: page envelopes, dumps, NDJSON, SSE, CSV, id lines,
stats documents."""

from .feed import (dump_quarantine, page_quarantine, parse_dump, parse_id_lines, parse_ndjson_lenient,
                   parse_ndjson_strict, parse_pages, parse_sse, parse_stats_doc, read_csv_ids, read_id_lines,
                   read_pages, read_stats_doc)

__all__ = ["dump_quarantine", "page_quarantine", "parse_dump", "parse_id_lines", "parse_ndjson_lenient", "parse_ndjson_strict",
           "parse_pages", "parse_sse", "parse_stats_doc", "read_csv_ids", "read_id_lines",
           "read_pages", "read_stats_doc"]
