"""Typed tables, snapshots, landed documents and bindings to test data."""
