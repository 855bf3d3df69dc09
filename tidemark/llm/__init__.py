"""Operators for large text corpora: search, near-duplicates, tokenizers, language, toxicity, extraction, mixing.

Nothing else in the library imports this subpackage.
"""
