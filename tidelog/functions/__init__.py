"""Column functions: text decoding, event time, rule hooks."""
