"""Readers, table layout, partition writers, adapters and generated data."""
