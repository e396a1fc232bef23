"""Incremental facts as streams."""
