"""Composite jobs: table sync and the document pipeline."""
