"""Composed flows."""
