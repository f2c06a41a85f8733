"""Pipes, delimited text, partitioned tables and the SQL surface."""
