"""Readers, sinks and the views over the benchmark tables."""
