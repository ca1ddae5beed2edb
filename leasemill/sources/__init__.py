"""Readers, writers, download and publication."""
