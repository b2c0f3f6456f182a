"""Operators for large-scale training-data pipelines (one module per operator).

Nothing else in the library imports this subpackage; ``queries`` registers one
query per operator and ``corpus_pipeline.py`` at the repository top chains four
of them.
"""
