"""Operators for preparing training text, each usable on its own and in ``corpus_pipeline``."""
