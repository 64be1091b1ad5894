"""Sources and sinks: pages, payloads, pagination, CSV and the versioned table."""
