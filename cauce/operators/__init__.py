"""DataFrame operators: projections, joins, aggregates, latest-per-key, reshape, profiling."""
