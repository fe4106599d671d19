"""DataFrame operators: row rules, joins, upsert and profiling."""
