"""Whole queries built from the operators, each with the SQL that checks it."""
