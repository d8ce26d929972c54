"""DataFrame operators: loading, scans, profiling, reconciliation, metrics,
extraction and sinks. Each takes and returns DataFrames."""
