"""Readers, extracts, projections and sinks."""
