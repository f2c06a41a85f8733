"""Applications: a parser, rules and a schema put together."""
