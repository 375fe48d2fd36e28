"""Relational operators the models and queries are composed of."""
