"""Scans, sinks, layer names and staging."""
