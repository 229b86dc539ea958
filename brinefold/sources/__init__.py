"""Stored tables and their registry."""
