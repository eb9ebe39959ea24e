"""Audit queries and product master-data jobs."""
