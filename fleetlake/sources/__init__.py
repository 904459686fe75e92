"""Readers: the landing directory and the generated sample tables."""
