"""Readers, writers and the adapters for the star-schema tables."""
