"""Whole runs: storage, modes, state and outcome."""
