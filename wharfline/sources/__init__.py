"""Readers, writers, partitioned tables and the canonical views."""
