"""Column expressions used inside the operators (scalar functions, §2.8)."""

from .ids import (invalid_reason, is_uuid, is_valid_id, string_id, with_element_id,
                  with_id_pick)
from .json import (field_path, strict_parse, top_keys, truthy_of, unwrap, vget, vkind, vtext,
                   vtruthy, with_strict_parse, wrap_parse)
from .num import idiv, keep_rows
from .text import extract_all, extract_first, request_outcome, string_format_class
from .timefmt import epoch_ms, ms_to_ts, ts_format_class, ts_normalise

__all__ = [
    "invalid_reason", "is_uuid", "is_valid_id", "string_id", "with_element_id", "with_id_pick",
    "field_path", "strict_parse", "top_keys", "truthy_of", "unwrap", "vget", "vkind", "vtext",
    "vtruthy", "with_strict_parse", "wrap_parse",
    "idiv", "keep_rows",
    "extract_all", "extract_first", "request_outcome", "string_format_class",
    "epoch_ms", "ms_to_ts", "ts_format_class", "ts_normalise",
]
