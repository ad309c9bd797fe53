"""Operators of a training-data pipeline; each query of ``queries.py`` applies one to its whole table."""
