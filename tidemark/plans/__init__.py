"""Queries over the provided tables, each with an equivalent SQL text for checking."""
