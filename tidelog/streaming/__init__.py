"""The whole flow as a Structured Streaming query."""
