"""Triggered jobs on file streams."""
