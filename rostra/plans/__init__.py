"""Staging, identity and mart models, and the reads on top of them."""
