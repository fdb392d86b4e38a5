"""Writers: partitioned Parquet, catalog tables, CSV/JSON, JDBC, schema JSON."""
