"""Table sources: typed scans, reference data, tables derived from the given Parquet files."""
