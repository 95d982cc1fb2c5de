"""Operators that prepare text and names for model training; nothing outside imports this subpackage."""
