"""Readers and derived tables."""
