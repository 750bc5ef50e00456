"""Scans, sinks, catalog and the repair load."""
