"""Whole plans: the batch pipeline, the SQL facade and the registry of queries."""
