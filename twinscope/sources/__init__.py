"""Readers, writers and the pair tables derived from the given data."""
