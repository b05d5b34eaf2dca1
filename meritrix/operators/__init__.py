"""Table operators: filters, joins, windows, quantiles, merges, keys, resolver."""
