"""End-to-end jobs (batch report, dashboard feeds, ingestion) and the query registry."""
