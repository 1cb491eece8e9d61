"""Operators for preparing training text, each by the method its module names.

Nothing outside this folder (and `corpus_pipeline.py`) depends on it.
"""
