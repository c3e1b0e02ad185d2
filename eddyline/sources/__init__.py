"""Readers; every one has a batch and a streaming form with the same columns."""
