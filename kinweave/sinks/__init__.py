"""Sinks: result files, target tables, merge and change feed."""
