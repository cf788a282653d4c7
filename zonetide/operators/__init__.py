"""DataFrame -> DataFrame operators: filters, joins, rollups, windows, ordering, changes, quality."""
