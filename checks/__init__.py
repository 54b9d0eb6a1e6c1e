"""Queries over the generated tables and the SQL they must agree with."""
