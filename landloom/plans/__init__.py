"""Schemas and whole jobs."""
