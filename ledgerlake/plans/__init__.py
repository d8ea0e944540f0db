"""Pipeline stages and the query registry."""
