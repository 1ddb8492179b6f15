"""Composed workflows, the SQL surface, and the catalogue of queries."""
