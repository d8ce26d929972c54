"""feedspark: loading, reconciling and profiling event feeds on Spark DataFrames."""

from .session import cut_lineage, ensure_checkpoint_dir, get_spark, scratch_path

__all__ = ["cut_lineage", "ensure_checkpoint_dir", "get_spark", "scratch_path"]
