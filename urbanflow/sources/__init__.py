"""Readers, writers and the text calendar."""
