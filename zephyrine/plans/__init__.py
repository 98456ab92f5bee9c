"""Composed queries and jobs."""
