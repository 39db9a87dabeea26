"""Reusable DataFrame operators below the level of one analysis."""
