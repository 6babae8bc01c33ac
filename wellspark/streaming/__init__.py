"""Keyed event streams and their idempotent sink."""
