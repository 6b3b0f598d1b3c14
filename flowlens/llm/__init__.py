"""Operators of a training-data pipeline (corpus preparation at scale).

Nothing outside this subpackage imports it; ``queries`` registers one query per operator.
"""
