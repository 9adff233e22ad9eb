"""Catalogue affinity on Spark: match, describe, segment, profile and rank products.

Every operator takes DataFrames and returns DataFrames. Expressions live in
``functions``, single steps in ``operators``, readers and writers in ``sources``
and whole pipelines in ``plans``.
"""
