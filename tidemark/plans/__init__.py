"""Bindings onto the driver tables, composed queries and the query registry."""
