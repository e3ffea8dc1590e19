"""Relational and series operators."""
