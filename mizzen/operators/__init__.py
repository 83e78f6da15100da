"""Relational operators whose rules differ from Spark's, and row changes as new versions of a table."""
