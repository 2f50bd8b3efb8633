"""Scans, header rules and sinks."""
