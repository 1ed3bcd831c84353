"""End-to-end jobs and the query catalogue on the shared tables."""
