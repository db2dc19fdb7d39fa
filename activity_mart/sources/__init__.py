"""Readers, sinks and the shared table store."""
