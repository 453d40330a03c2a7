"""Tessera functions."""
