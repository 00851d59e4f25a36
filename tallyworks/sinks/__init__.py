"""Writers: catalog tables and parquet files."""
