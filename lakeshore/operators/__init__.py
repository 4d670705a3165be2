"""DataFrame -> DataFrame operators: quality checks, joins, attribution, row changes, views."""
