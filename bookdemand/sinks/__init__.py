"""Writers: noop, CSV, staged publish, partitioned parquet landing zone."""
