"""Whole runs: the match pipeline and the registered queries."""
