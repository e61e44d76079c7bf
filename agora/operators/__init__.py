"""DataFrame operators: top-N and group limits, the week mask, joins, counts."""
