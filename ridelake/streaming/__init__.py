"""Incremental loading that follows arriving files instead of a high-water mark."""
