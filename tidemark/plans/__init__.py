"""Declarative loads: the spec, its hooks and its execution."""
