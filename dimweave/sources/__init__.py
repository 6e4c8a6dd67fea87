"""Schemas, ingest of source sheets, scratch tables and the snapshot warehouse."""
