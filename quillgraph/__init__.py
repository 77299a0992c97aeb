"""A Spark-native engine for bibliographic tables: ingestion, deduplication, citation neighbourhoods, metrics."""
