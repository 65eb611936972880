"""DataFrame operators: filters, joins, aggregates, rankings and audits."""
