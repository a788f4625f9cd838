"""End-to-end pipeline and the named query catalogue."""
