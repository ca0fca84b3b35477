"""Operators on text; nothing outside this subpackage imports it."""
