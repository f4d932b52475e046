"""Scans, sinks and run artifacts."""
