"""Structured Streaming forms of the batch operators.

The reference is batch-only; these wire the same DataFrame operators to
streaming sources so that scores stay current as posts arrive.
"""
