"""DataFrame-to-DataFrame operators: cleaning, filters, joins, aggregates, checks."""
