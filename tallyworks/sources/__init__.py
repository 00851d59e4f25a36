"""Readers: transaction CSV, JSON-lines logs, tables and SQL."""
