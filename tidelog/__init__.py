"""Log lines to partitioned event tables on Spark, in batch and streaming."""
