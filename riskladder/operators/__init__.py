"""Reusable DataFrame operators of the rating method."""
