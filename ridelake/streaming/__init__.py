"""Structured Streaming jobs of the station-status feed."""
