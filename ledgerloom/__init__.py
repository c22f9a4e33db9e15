"""Ledger, clearance and collections analytics written on the public PySpark API."""
