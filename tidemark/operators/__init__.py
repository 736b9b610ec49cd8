"""DataFrame operators of the synchronisation."""
