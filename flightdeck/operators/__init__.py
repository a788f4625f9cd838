"""DataFrame operators of the engine."""
