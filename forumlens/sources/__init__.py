"""Readers and writers.  Every reader takes an explicit schema (no
inference on the hot path) and returns a DataFrame."""
