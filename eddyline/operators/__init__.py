"""Batch operators, all built from DataFrame expressions."""
