"""Operators that prepare training data: cleaning, matching, formatting and mixing of documents."""
