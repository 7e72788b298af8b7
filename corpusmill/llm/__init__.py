"""Operators for building training corpora, and their registered queries."""
