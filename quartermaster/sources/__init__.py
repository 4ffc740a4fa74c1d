"""Sources and sinks: CSV/Parquet scans, contracts, file listings."""
