"""Operators for building training corpora (documents, pages, benchmarks).

One module per operator; ``queries`` registers them over the driver tables.
Nothing outside this package (and ``corpus_pipeline``) imports it.
"""
