"""Operators of a training-data pipeline (quality, dedup, tokens, mixing, search).

Nothing else in the library imports this subpackage; ``queries`` holds the
registered queries and their SQL.
"""
