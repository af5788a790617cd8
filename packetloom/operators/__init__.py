"""Relational operators over packet tables."""
