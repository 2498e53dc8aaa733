"""Operators for building training corpora.

Nothing else in the library imports this subpackage; ``corpus_pipeline.py``
at the top of the repository and the tests in ``tests/llm`` use it.
"""
