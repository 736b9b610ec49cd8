"""Spark-native collection, canonicalisation, latest-wins synchronisation and reconciliation of metadata records."""
