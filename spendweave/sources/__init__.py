"""Readers, writers, batch windows."""
