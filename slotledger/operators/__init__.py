"""Ledger operators: pure, lazy ``DataFrame -> DataFrame`` functions."""
