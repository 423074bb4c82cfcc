"""Relational operators: shaping, projection, joins, aggregation, loads, quality, analytics."""
