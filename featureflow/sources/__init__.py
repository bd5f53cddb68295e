"""Scans, generated rows, sinks and materialised stages."""
