"""Operators on point tables."""
