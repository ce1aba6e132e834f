"""Operators of a training-data pipeline over large text tables.

Nothing else in the library imports this subpackage.  ``queries`` registers
one query per operator; ``corpus_pipeline.py`` chains five of them.
"""
