"""Scalar column expressions (columns) and frame helpers (frames)."""
