"""Operators for large training-text collections. Nothing outside this folder imports it."""
