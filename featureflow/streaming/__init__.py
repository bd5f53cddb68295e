"""Incremental form of the featurise flow for growing image sets."""
