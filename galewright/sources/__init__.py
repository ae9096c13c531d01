"""Readers, sinks and versioned tables."""
