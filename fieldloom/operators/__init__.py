"""Relational operators: schema alignment, joins, pivots, audits."""
