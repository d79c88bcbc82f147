"""Sources and sinks: test-data mapping, files, NDJSON, weather documents, tables."""
