"""Bindings of the driver tables to the review schema, queries and their SQL."""
