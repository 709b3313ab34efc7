"""DataFrame operators: flattening, deduplication, numbering, checks, lookups and reports."""
