"""Column functions of the synchronisation."""
