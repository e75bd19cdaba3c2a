"""Feeds: landing, parsing, validation."""
