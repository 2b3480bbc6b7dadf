"""Queries over the given tables, one or more per operator, and the SQL to check them."""
