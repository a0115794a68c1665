"""Readers and row producers."""
