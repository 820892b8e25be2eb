"""Writers: Parquet year tables, bucketed tables, gzip CSV, data dictionary."""
