"""Scans, sources, sinks and catalog helpers."""
