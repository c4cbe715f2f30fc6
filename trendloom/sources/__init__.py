"""Readers: landed payloads to typed tables."""
