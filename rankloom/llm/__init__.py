"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; ``corpus_pipeline.py``
at the top of the repository belongs to it."""
