"""Composed pipelines and registered queries."""
