"""Operators for preparing language-model training data.

One module per operator; ``queries.py`` registers the digest queries.  Nothing
outside this folder and ``corpus_pipeline.py`` imports it.
"""
