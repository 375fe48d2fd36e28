"""Readers from landed payloads to raw tables."""
