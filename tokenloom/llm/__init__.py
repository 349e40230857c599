"""Operators for large training corpora, each by its own method, and their queries."""
