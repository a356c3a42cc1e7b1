"""Sources: raw-log readers and adapters over the given parquet tables."""
