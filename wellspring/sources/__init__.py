"""Readers of the source programs' extracts."""
