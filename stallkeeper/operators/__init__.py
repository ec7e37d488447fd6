"""Reusable building blocks: ordered windows, rule checks, similarity join."""
