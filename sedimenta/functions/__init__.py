"""Column expressions: text, numbers and dates. No session, no I/O, no Python UDF."""
