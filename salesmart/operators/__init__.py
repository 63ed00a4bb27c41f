"""Reusable DataFrame operations of the mart."""
