"""Readers and writers: files, response pages, pulls, control tables, catalog."""
