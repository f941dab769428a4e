"""Readers, gates, sinks and the fixture views over the driver tables."""
