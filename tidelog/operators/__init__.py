"""DataFrame operators: parsing, mapping, enrichment, buckets, progress, merge."""
