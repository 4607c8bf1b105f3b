"""Composite plans a user runs: each is a function from tables to tables."""
