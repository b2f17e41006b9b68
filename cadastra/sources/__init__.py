"""Sources and sinks: registry CSV files, Parquet, catalog tables, JDBC tables."""
