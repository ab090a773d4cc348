"""Operators for preparing large text corpora for language-model training.

Nothing outside this subpackage imports it.  ``llm.queries`` holds the thin
driver queries, one module per operator holds the operator itself.
"""
