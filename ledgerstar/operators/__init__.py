"""DataFrame operators: projection, casts, dedup, joins, checks and profiles."""
