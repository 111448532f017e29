"""Whole jobs over the operators, and the queries on the given tables."""
