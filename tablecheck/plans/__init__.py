"""Whole runs over catalog databases."""
