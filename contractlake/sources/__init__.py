"""Readers: award XML, zip archives, HTML index pages, file listings."""
