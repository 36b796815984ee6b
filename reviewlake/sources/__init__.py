"""Readers, writers and test-input derivations."""
