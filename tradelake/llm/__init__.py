"""Operators for preparing training text: ten jobs over documents and web pages.

Nothing else in the package imports this one. Each module holds one operator;
``queries`` registers one query per operator, and ``corpus_pipeline.py`` at the
repository top chains five of them.
"""
