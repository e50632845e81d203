"""Queries and pipelines of the ride model."""
