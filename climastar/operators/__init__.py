"""Relational operators composed from DataFrame primitives."""
