"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; ``reqflow.llm.registry`` holds the
named queries and their SQL.
"""
