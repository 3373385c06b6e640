"""Whole runs: the daily pipeline, and the ledger over the sample tables."""
