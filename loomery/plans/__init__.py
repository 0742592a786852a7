"""Registered queries over the standard tables."""
