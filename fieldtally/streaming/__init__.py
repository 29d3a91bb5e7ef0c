"""Sinks and the running of streaming queries."""
