"""Relational building blocks shared by the report plans."""
