"""Table-to-table operators: typing, lookups, ordered scans, sampling, summaries."""
