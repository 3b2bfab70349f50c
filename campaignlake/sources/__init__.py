"""Readers, writers and the campaign table."""
