"""DataFrame operators: selection, joins, regridding, aggregates, windows and sets."""
