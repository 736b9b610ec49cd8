"""Continuous synchronisation over Structured Streaming."""
