"""Readers, integrity checks and writers."""
