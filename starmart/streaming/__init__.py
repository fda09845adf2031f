"""Incremental processing of landed files."""
