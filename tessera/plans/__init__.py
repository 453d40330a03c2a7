"""Tessera plans."""
