"""Continuous variant of the daily facts."""
