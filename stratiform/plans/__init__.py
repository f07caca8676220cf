"""Composed layer transformations and the registered queries."""
