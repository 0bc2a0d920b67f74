"""Operators for building language-model training data.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; ``queries.py`` registers one query per operator and the
corpus pipeline.
"""
