"""Corpus readers and writers (group A)."""
