"""Operators for text corpora that feed language models. Nothing else in the library imports this package."""
