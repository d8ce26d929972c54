"""Structured Streaming: idempotent file-stream loading, watermark dedup,
windowed counts and worker health state."""

from .loader import (create_target, land_in_time_order, load_batch, stream_dedup_within_watermark,
                     stream_idempotent_load, watermark_figures)
from .windows import fold_window_log, stream_window_counts

__all__ = ["create_target", "land_in_time_order", "load_batch", "stream_dedup_within_watermark",
           "stream_idempotent_load", "watermark_figures", "fold_window_log", "stream_window_counts"]
