"""Catalogue sources and sinks (CSV, Parquet, JSON, Kafka) and the test fixture view."""
