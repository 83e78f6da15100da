"""Verified export and restore of tables."""
