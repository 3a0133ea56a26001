"""A package, so that its conftest does not stand in for the one above it."""
