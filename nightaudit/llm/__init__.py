"""Operators for large-scale text preparation. Nothing else in the library imports this subpackage."""
