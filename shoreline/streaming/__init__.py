"""Structured Streaming entry points: change streams applied through the
guarded merge, and new files appended to an asset table."""
