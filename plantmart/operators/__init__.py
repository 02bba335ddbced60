"""DataFrame-to-DataFrame operators: merging, filters, joins and contract checks."""
