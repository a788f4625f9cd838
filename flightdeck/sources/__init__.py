"""Readers: monthly CSV scans, lookups, manifests and the test-table binding."""
