"""Event-analytics lakehouse on Spark: bronze JSON to silver Parquet to a ranked star schema."""
