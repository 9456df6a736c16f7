"""Readers.  Every one returns a lazy DataFrame."""
