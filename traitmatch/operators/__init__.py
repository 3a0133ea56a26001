"""Operators: generic relational building blocks and the talent models."""
