"""Declared data model: target schemas and the lookup tables."""
