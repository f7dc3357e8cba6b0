"""Continuous scoring and counting."""
