"""Composite queries and jobs."""
