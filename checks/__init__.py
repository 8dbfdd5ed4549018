"""Test views over the given tables, the queries on them and their SQL."""
