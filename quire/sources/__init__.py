"""Readers that turn files, JSON, HTML and bytes into tables."""
