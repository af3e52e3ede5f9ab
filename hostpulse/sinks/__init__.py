"""Writers: Parquet folders and tables, JSON-lines files, Kafka topics, JDBC tables."""
