"""Incremental landing of new award files."""
