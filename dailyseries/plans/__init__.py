"""Composed plans: fixtures from the driver tables, ranking helpers, the
full feature pipeline and the query registry."""
