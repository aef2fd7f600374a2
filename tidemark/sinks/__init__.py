"""Append topics, keyed upsert tables and the CDC state table."""
